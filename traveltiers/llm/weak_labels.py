"""Operator 9: quality by weak labels.

LABELLERS look at a whole text and vote junk, clean or nothing; they overlap on purpose.
Expectation-maximisation over the counts of vote patterns (at most 3**6 of them, counted by
Spark over all documents) estimates each labeller's rates for both classes and the share of
junk; no true label is used. Each pattern's posterior labels the documents of a bounded
sample (SAMPLE_ROWS, the first by the hash of the id; repeated patterns in proportion), on
which a hashed linear scorer learns. It scores every whole text, also where no labeller
votes; documents scored under THRESHOLD are kept.

Nulls and empty texts get no votes and no features, hence the bias's score. Rows repeat as in
the input; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm import ftrl
from traveltiers.llm.common import map_batches, table, words

SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
ROUNDS = 100
ABSTAIN, CLEAN, JUNK = 0, 1, 2
SYMBOLS = "#*$%&|<>"
MARKS = "!#*$%&|<>~^=_@"

#: Classes of code points for the scorer (ASCII; above it letters are told from the rest).
_CLASS = np.zeros(0x110000, np.uint8)
for _i in range(128):
    _c = chr(_i)
    _CLASS[_i] = (1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c == " " else 5 if _c == "\n"
                  else 6 + ".,;:!?'\"()[]-/#*$%&|<>~^=_@\\{}`+".find(_c) if _c in ".,;:!?'\"()[]-/#*$%&|<>~^=_@\\{}`+" else 40)
_CLASS[128:] = 41
for _i in range(0xC0, 0x250):
    _CLASS[_i] = 1 if chr(_i).islower() else 2 if chr(_i).isupper() else 41


def measures(text: str | None, ws: list[str]) -> tuple:
    """Shares that the labellers look at: symbols, capitals, echoes, marks, lines repeated, distinct words."""
    n, chars = len(ws), sum(map(len, ws))
    capitals = sum(1 for w in ws if w.isupper() and len(w) > 1)
    longer = sum(1 for w in ws if len(w) > 1 and w[:2].isalpha()) or 1
    echoes = sum(map(str.__eq__, ws, ws[1:]))
    return (sum(map(text.count, SYMBOLS)) / chars, capitals / longer, echoes / n, sum(map(text.count, MARKS)) / n,
            repeated(ws), len(set(ws)) / n)


def repeated(ws: list[str]) -> float:
    """Share of the 3-word windows that repeat an earlier one."""
    return 1 - len(set(zip(ws, ws[1:], ws[2:]))) / (len(ws) - 2) if len(ws) > 2 else 0.0


def band(x: float, clean: float, junk: float) -> int:
    return JUNK if x > junk else CLEAN if x < clean else ABSTAIN


def votes(text: str | None) -> tuple[int, ...]:
    """One vote a labeller."""
    ws = words(text)
    if not ws:
        return (ABSTAIN,) * 6
    symbols, capitals, echoes, marks, repeats, distinct = measures(text, ws)
    return (band(symbols, 0.01, 0.05), band(capitals, 0.2, 0.6), band(echoes, 0.03, 0.2), band(marks, 0.05, 0.3),
            band(repeats, 0.15, 0.5), ABSTAIN if len(ws) < 50 else band(-distinct, -0.25, -0.08))


def fit_votes(patterns: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Posterior probability of junk for every pattern, by EM from the majority vote."""
    if not patterns:
        return {}
    keys = sorted(patterns)
    v, n = np.array(keys), np.array([patterns[k] for k in keys], float)
    lean = (v == JUNK).sum(1) - 0.5 * (v == CLEAN).sum(1)
    q = np.where(lean > 0, 0.9, np.where((v == JUNK).any(1), 0.5, 0.05))
    for _ in range(ROUNDS):
        logs = np.zeros((len(keys), 2))
        for c, weight in enumerate((n * (1 - q), n * q)):
            logs[:, c] = np.log((weight.sum() + 1) / (n.sum() + 2))
            for j in range(v.shape[1]):
                rate = np.array([weight[v[:, j] == x].sum() + 0.1 for x in (ABSTAIN, CLEAN, JUNK)])
                logs[:, c] += np.log(rate / rate.sum())[v[:, j]]
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -35, 35)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return dict(zip(keys, map(float, q)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: shares of runs of four character classes, and steps of how words repeat."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0)
    cls = _CLASS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))  # runs of one class: their kind, not their length
    runs = cls[start]
    code = np.concatenate([runs, runs[:-1] * 64 + runs[1:] + 4096, (runs[:-2] * 64 + runs[1:-1]) * 64 + runs[2:] + 8192])
    at, count = np.unique(code, return_counts=True)
    ws = words(text)
    n = max(1, len(ws))
    echo = sum(map(str.__eq__, ws, ws[1:])) / n
    steps = [500_000 + k for k, x in enumerate((0.05, 0.1, 0.2, 0.4)) if echo > x] + [500_100 + k for k, x in enumerate((0.15, 0.3, 0.5, 0.7)) if repeated(ws) > x]
    at = np.concatenate([at, np.array(steps, np.int64)])
    value = np.concatenate([np.sqrt(count / len(runs)), np.ones(len(steps))])
    return (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - ftrl.BITS)).astype(np.int64), value


def voted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's ``text`` replaced by its ``votes``, the pattern as digits."""
    named = docs.select(F.col(f"`{text}`").alias("t"))
    return map_batches(named, lambda cols: {"votes": ["".join(map(str, votes(t))) for t in cols["t"]]}, "votes string")


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> tuple[dict, dict[int, float]]:
    """Posterior by vote pattern over all documents, and the scorer's weights."""
    counted = voted(docs, text).groupBy("votes").count().collect()  # at most 3**6 rows
    posterior = fit_votes({tuple(map(int, r["votes"])): r["count"] for r in counted})
    ids = docs.select(F.col(f"`{key}`").alias("id")).dropna().distinct().orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sample = texts.join(F.broadcast(ids), "id").dropDuplicates(["id"])  # broadcast: at most `rows` rows
    known = docs.sparkSession.sparkContext.broadcast(posterior)
    labelled = map_batches(sample, lambda cols: cols | {"y": [known.value[votes(t)] for t in cols["text"]]},
                           f"id {sample.schema['id'].dataType.simpleString()}, text string, y double")
    return posterior, ftrl.fit(labelled, features)


def score(docs: DataFrame, weights: dict[int, float], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns as ``k0``, ``k1`` ..., and ``__junk``, the probability of junk."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    named = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], *[F.col(f"`{text}`").alias("__text")] * (text not in keep))
    read = f"k{keep.index(text)}" if text in keep else "__text"  # a kept text goes to the worker once
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields if f.name != "__text")
    return map_batches(named, lambda cols, own: cols | {"__junk": [own.score(t) for t in cols[read]]},
                       f"{kinds}, __junk double", lambda: ftrl.Scorer(model.value, features))


def classify(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, quality (1 - probability of junk), kept."""
    out = score(docs, fit(docs, text, key)[1], text, (key,))
    return out.select(F.col("k0").alias(key), (1 - F.col("__junk")).alias("quality"), (F.col("__junk") < THRESHOLD).alias("kept"))


def keep_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = tuple(docs.columns)
    return score(docs, fit(docs, text, key)[1], text, names).filter(F.col("__junk") < THRESHOLD).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])


def query(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
