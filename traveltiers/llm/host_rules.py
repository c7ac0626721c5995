"""Operator 1: quality rules judged by host.

Each document gets base counts from its whole text. A document breaks the base rules
(too short, or mostly repeated word windows) or the soft ones (symbols, repeats, word
length). Broken rules are counted by host (``source``); the hosts' rates are shrunk with
a beta prior fitted to all hosts by the method of moments; the host verdicts are joined
back to the documents:

* ``trusted``: only the base rules bind;
* ``watched`` (shrunk rate of at least WATCH): the soft rules bind too;
* ``blocked`` (shrunk rate of at least BLOCK): all documents of the host go.

Nulls: a null text has no words (the base rules fail it); a null host is the host ``''``;
a null id stays null. Repeated rows count as often as they occur. An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import cut, map_batches, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: Soft rules: symbols per word character, repeated words, mean word length.
SOFT_SYMBOL_PCT, SOFT_REPEAT_PCT, SOFT_WORD_CHARS = 10, 20, 20
WATCH, BLOCK = 0.4, 0.8
#: Bounds of the prior's weight, in documents.
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0

_BLANK = " \t\n\x0b\x0c\r"
BASE = "__n_words long, __word_chars long, __n_symbols long, __n_dup_lines long, __n_repeat_words long"


def repeat_words(ws: list[str]) -> int:
    """Words inside 3-word windows that the text has at least twice."""
    n = len(ws)
    if n < 4:
        return 0
    codes: dict[str, int] = {}
    a = np.fromiter((codes.setdefault(w, len(codes)) for w in ws), np.int64, n)
    m = len(codes)
    if m == n:
        return 0
    if m < 2_000_000:
        key = (a[:-2] * m + a[1:-1]) * m + a[2:]
    else:  # three codes no longer fit 63 bits: number the pairs first
        key = np.unique(a[:-2] * m + a[1:-1], return_inverse=True)[1] * m + a[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    ws = words(text)
    if not ws:
        return 0, 0, sum(text.count(c) for c in SYMBOLS) if text else 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return (len(ws), sum(map(len, ws)), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeat_words(ws))


def features(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns as ``k0``, ``k1`` ..., with ``__host``, the base counts, ``__base_failed`` and ``__soft_failed``."""
    named = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                        F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("__host"), *[F.col(f"`{text}`").alias("__text")] * (text not in keep))
    own = f"k{keep.index(text)}" if text in keep else "__text"  # a kept text goes to the worker once
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields if f.name != "__text")

    def count(cols) -> dict:
        got = list(zip(*map(base_counts, cols[own])))  # a batch has a row at least
        return cols | dict(zip(("__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words"), got))

    counted = map_batches(named, count, f"{kinds}, {BASE}")
    w, r = F.col("__n_words"), F.col("__n_repeat_words")
    base = (w < MIN_WORDS) | (100 * r > MAX_REPEAT_PCT * w)
    soft = ((100 * F.col("__n_symbols") > SOFT_SYMBOL_PCT * F.col("__word_chars")) | (100 * r > SOFT_REPEAT_PCT * w)
            | (F.col("__word_chars") > SOFT_WORD_CHARS * w))
    return counted.select("*", base.alias("__base_failed"), soft.alias("__soft_failed"))


def host_verdicts(feats: DataFrame) -> DataFrame:
    """One row a host: documents, broken ones, shrunk rate, verdict. Only two sums for the prior reach the driver."""
    broken = F.col("__base_failed") | F.col("__soft_failed")
    hosts = cut(feats.groupBy("__host").agg(F.count("*").alias("host_docs"), F.sum(broken.cast("long")).alias("host_failed")))
    n, f = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    s = hosts.agg(F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(n * n).alias("nn"),
                  F.sum(f * f / n).alias("ff")).first()
    mean, weight = prior(s["k"], s["n"] or 0.0, s["f"] or 0.0, s["nn"] or 0.0, s["ff"] or 0.0)
    rate = F.round((f + F.lit(mean * weight)) / (n + F.lit(weight)), 6)
    verdict = F.when(rate >= BLOCK, "blocked").when(rate >= WATCH, "watched").otherwise("trusted")
    return hosts.select("__host", "host_docs", "host_failed", rate.alias("host_rate"), verdict.alias("host_verdict"))


def prior(k: int, n: float, f: float, nn: float, ff: float) -> tuple[float, float]:
    """Mean and weight of the beta prior: the spread between hosts beyond what chance within them gives."""
    if not n:
        return 0.0, PRIOR_MIN
    p = f / n
    within = p * (1 - p)
    spread = n - nn / n
    between = (ff - n * p * p - (k - 1) * within) / spread if spread > 0 else 0.0
    weight = within / between - 1 if between > 1e-12 else PRIOR_MAX
    return p, min(PRIOR_MAX, max(PRIOR_MIN, weight))


def with_verdicts(feats: DataFrame, hosts: DataFrame) -> DataFrame:
    """``feats`` with its host's columns and ``__kept``. A plain join: Spark broadcasts few hosts and splits a hot one."""
    joined = feats.join(hosts, "__host", "left")
    bad = (F.col("host_verdict") == "blocked") | ((F.col("host_verdict") == "watched") & F.col("__soft_failed"))
    return joined.withColumn("__kept", ~F.col("__base_failed") & ~bad)


def judge(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """Per document: base counts, base_failed, soft_failed, the host's figures and kept."""
    feats = cut(features(docs, text, host, (key,)))
    out = with_verdicts(feats, host_verdicts(feats))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "soft_failed")
    return out.select(F.col("k0").alias(key), *[F.col(f"__{c}").alias(c) for c in names],
                      "host_docs", "host_failed", "host_verdict", F.col("__kept").alias("kept"))


def keep_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The counts are made twice (hosts first, then rows) instead of moving whole texts through a join by id.
    """
    names = tuple(docs.columns)
    hosts = cut(host_verdicts(features(docs, text, host, ())))
    out = with_verdicts(features(docs, text, host, names), hosts).filter("__kept")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS a FROM w),
t AS (SELECT doc_id, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM t),
v AS (SELECT doc_id, twice OR coalesce(lag(twice) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit
      FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n_repeat_words FROM v GROUP BY doc_id),
f AS (SELECT doc_id, host, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
             len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN s USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             100 * n_symbols > 10 * word_chars OR 100 * n_repeat_words > 20 * n_words OR word_chars > 20 * n_words AS soft_failed FROM f),
h AS (SELECT host, count(*) AS host_docs, count(*) FILTER (WHERE base_failed OR soft_failed) AS host_failed FROM g GROUP BY host),
q AS (SELECT count(*) AS k, sum(host_docs) AS n, sum(host_failed) / sum(host_docs) AS p, sum(host_docs * host_docs) AS nn,
             sum(host_failed * host_failed / host_docs) AS ff FROM h),
u AS (SELECT p, CASE WHEN n - nn / n > 0 AND (ff - n * p * p - (k - 1) * p * (1 - p)) / (n - nn / n) > 1e-12
             THEN least(1000, greatest(2, p * (1 - p) / ((ff - n * p * p - (k - 1) * p * (1 - p)) / (n - nn / n)) - 1))
             ELSE 1000 END AS m FROM q),
x AS (SELECT h.*, round((host_failed + p * m) / (host_docs + m), 6) AS rate FROM h, u),
y AS (SELECT *, CASE WHEN rate >= 0.8 THEN 'blocked' WHEN rate >= 0.4 THEN 'watched' ELSE 'trusted' END AS host_verdict FROM x)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, soft_failed,
       host_docs::BIGINT AS host_docs, host_failed::BIGINT AS host_failed, host_verdict,
       NOT base_failed AND host_verdict <> 'blocked' AND NOT (host_verdict = 'watched' AND soft_failed) AS kept
FROM g JOIN y USING (host)
"""


def query(spark, sf_dir: str) -> DataFrame:
    from traveltiers.llm.common import table

    return judge(table(spark, sf_dir, "documents"))
