"""Operator 12: alignment of two tokenizers over the corpus, each distinct text once.

Rows are shuffled by their full text, so each distinct text is tokenised and aligned once and
carries the number of its rows. Tokenizer A (byte-level BPE) encodes a space and the text,
tokenizer B (sentencepiece) the text. Byte offsets at which tokens of both end cut them into
groups; every A token is linked with every B token of its group. The documents that hold an id
pair linked are counted over the corpus, distinct texts weighted by their rows, and each text's
measures are joined back to its rows by a 128-bit hash of the text.

Within a text, segments are cut before each space or line feed that follows other than white
space. Neither tokenizer joins across such a place (checked when they are loaded), and both end
a token there, so groups never cross it; a worker aligns each segment once while it remembers
it (MEMO segments). A text in which a segment's tokens don't give its bytes back is looked at as
a whole.

The HEAVY most frequent pairs, a fixed number, are broadcast and looked up where the text's
pairs lie; the others join the table of all pairs by shuffle. Both give the same numbers, so
HEAVY moves cost and no result.

Null and empty texts, and texts whose joined A or B bytes differ from space and text, have no
tokens: zeros and an empty ``groups_sha256``. Repeated rows repeat in the result; a null key
stays. An empty table gives an empty result. A very long text is one row of its task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traveltiers.llm.common import arrow_schema, map_batches, remember, table
from traveltiers.session import scratch_path

HEAVY = 1 << 18
#: Segments that a worker remembers (some 200 MB).
MEMO = 500_000
#: Code points of texts that are aligned together, and pairs that a task sums before it passes them on.
HOLD_CHARS = 2_000_000
HOLD_PAIRS = 4_000_000
SPACE = "▁"
_BORDER = re.compile(r"(?<=\S)(?=[ \n])")
_WIDE = re.compile(r"\s\s|\0")


def segments(text: str) -> list[str]:
    """A space and the text, cut before each space or line feed that follows other than white space."""
    s = " " + text
    if _WIDE.search(s):
        return _BORDER.split(s)
    return s.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level BPE files write bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Segments(dict):
    """Numbers of segments in the order in which they appear; ``new`` holds those not aligned so far."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, s: str) -> int:
        self[s] = out = len(self)
        self.new.append(s)
        return out


class Aligner:
    """Both tokenizers and the alignments of the segments seen."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.fast = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        split = json.loads(spec).get("pre_tokenizer") or {}
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or json.loads(spec).get("normalizer"):
            raise ValueError("tokenizer A must be a byte-level BPE that splits words and leaves texts as they are")
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            plain = not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))
            if plain and len(piece) > 1 and (SPACE in piece.lstrip(SPACE) or "\n" in piece):
                raise ValueError("a piece of tokenizer B reaches across a segment's border")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.space = self.b.piece_to_id(SPACE)
        self.width = len(self.b_bytes)  # a pair's number: A id * width + B id
        self.reset()

    def reset(self) -> None:
        self.codes = Segments()
        self.said: list[str | None] = []  # the groups as text; None: tokens that don't give the bytes back
        self.sums = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.pairs, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def tokens(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both for segments; the one that opens a text, or any after it, brings its own space."""
        a = [e.ids for e in self.fast(parts, add_special_tokens=False)]
        # B puts a space before what it gets: it takes the segment's own one, or is dropped again before a line feed.
        b = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        for p, x, y in zip(parts, a, b):
            if p[0] != " ":
                if y[:1] != [self.space]:
                    raise ValueError("tokenizer B doesn't keep a line feed apart")
                y = y[1:]
            elif p == " ":
                y = [self.space]  # the library gives an empty text no space
            yield x, y

    def groups(self, a: list[int], b: list[int], data: bytes) -> list[tuple[list[int], list[int]]] | None:
        """The groups of one text or segment; None where the tokens don't give the bytes back."""
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        out, i, j, fa, fb, ends_a, ends_b = [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            ends_a += len(self.a_bytes[a[i]])
            i += 1
            while ends_b < ends_a and j < len(b):
                ends_b += len(self.b_bytes[b[j]])
                j += 1
            if ends_a == ends_b:
                out.append((a[fa:i], b[fb:j]))
                fa, fb = i, j
        return out

    def measures(self, groups: list[tuple[list[int], list[int]]] | None) -> tuple[str | None, list[int], list[int]]:
        if groups is None:
            return None, [0, 0, 0, 0], []
        said = ";".join([",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups])
        pairs = [i * self.width + j for x, y in groups for i in x for j in y]
        return said, [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(pairs)], pairs

    def learn(self) -> None:
        """Align the segments that have a number and nothing else yet."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        sums, pairs, sizes = [], [], []
        for s, (a, b) in zip(new, self.tokens(new)):
            said, four, own = self.measures(self.groups(a, b, s.encode()))
            self.said.append(said)
            sums.append(four)
            pairs += own
            sizes.append(len(own))
        self.sums = np.concatenate([self.sums, np.array(sums, np.int64)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        self.pairs = np.concatenate([self.pairs, np.array(pairs, np.int64)])

    def whole(self, text: str) -> tuple[str | None, list[int], list[int]]:
        """A text by itself, without segments."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        return self.measures(self.groups(a, b, (" " + text).encode()))

    def of(self, texts: list[str]) -> Iterator[tuple[str, list[int], np.ndarray, np.ndarray]]:
        """Per text: its groups as text, the four sums, its distinct pairs in order and how often it holds each."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= HOLD_CHARS:
                yield from self.block(held)
                held, size = [], 0
        if held:
            yield from self.block(held)

    def block(self, texts: list[str]) -> Iterator[tuple[str, list[int], np.ndarray, np.ndarray]]:
        if len(self.codes) > MEMO:
            self.reset()
        split = [segments(t) if t else [] for t in texts]
        sizes = np.array([len(s) for s in split])
        code = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        self.learn()
        n, span = len(texts), len(self.codes)
        doc = np.repeat(np.arange(n), sizes)
        cell, times = np.unique(doc * span + code, return_counts=True)  # (text, segment)
        doc, code = cell // max(1, span), cell % max(1, span)
        sums = np.stack([np.bincount(doc, times * self.sums[code, i], n) for i in range(4)], 1).astype(np.int64)
        each = self.offsets[code + 1] - self.offsets[code]
        ends = np.cumsum(each)
        at = np.repeat(self.offsets[code] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)
        top = len(self.a_bytes) * self.width
        cell, back = np.unique(np.repeat(doc, each) * top + self.pairs[at], return_inverse=True)  # (text, pair)
        often = np.bincount(back, np.repeat(times, each), len(cell)).astype(np.int64)
        cuts = np.searchsorted(cell, np.arange(n + 1) * top)
        for i, (t, parts) in enumerate(zip(texts, split)):
            said = [self.said[c] for c in map(self.codes.__getitem__, parts)]
            if None in said:
                one, four, own = self.whole(t)
                yield one or "", four, *np.unique(np.array(own, np.int64), return_counts=True)
            else:
                yield ";".join(said), sums[i].tolist(), cell[cuts[i]:cuts[i + 1]] - i * top, often[cuts[i]:cuts[i + 1]]


_aligners: dict[int, Aligner] = {}
remember(__name__, _aligners)


def aligner(spec: str, model: bytes) -> Aligner:
    """One aligner a worker process and pair of files, kept between tasks."""
    key = hash((spec, model))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(spec, model)
    return _aligners[key]


def _packed(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes()


def _pairs_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of packed rows in a row, and the size of each."""
    return np.frombuffer(b"".join(data), "<u4").astype(np.int64), np.array([len(x) // 4 for x in data])


def align_texts(docs: DataFrame, spec: str, model: bytes, folder: str, text: str = "text") -> DataFrame:
    """Each distinct text once: hash (h1, h2), rows, n_a, n_b, n_groups, n_links, groups_sha256, packed pairs and how often each is linked.

    Written to ``folder``/texts and read again.
    """
    sc = docs.sparkSession.sparkContext
    files = sc.broadcast((spec, model))
    t = F.col(f"`{text}`")
    once = docs.select(t.alias("t")).where(F.length("t") > 0).groupBy("t").agg(F.count(F.lit(1)).alias("rows"))
    once = once.select(F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), F.col("t")).alias("h2"), "rows", "t")

    def run(cols: dict, own: Aligner) -> dict:
        out: dict = {c: cols[c] for c in ("h1", "h2", "rows")}
        out |= {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links")}
        for said, four, pairs, links in own.of(cols["t"]):
            for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), four):
                out[c].append(x)
            out["groups_sha256"].append(hashlib.sha256(said.encode()).hexdigest() if said else "")
            out["pairs"].append(_packed(pairs))
            out["links"].append(_packed(links))
        return out

    schema = "h1 long, h2 long, rows long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"
    map_batches(once, run, schema, lambda: aligner(*files.value)).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/texts")
    return docs.sparkSession.read.parquet(f"{folder}/texts")


def pair_table(texts: DataFrame, width: int, folder: str) -> DataFrame:
    """The corpus's id pairs: pair, a, b, docs (documents that hold it linked), best (the highest of its A id). Written to ``folder``/pairs."""
    schema = arrow_schema("pair long, docs long")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, weight, size = [], [], 0

        def flush() -> pa.RecordBatch:
            pair, back = np.unique(np.concatenate(held), return_inverse=True)
            docs = np.bincount(back, np.concatenate(weight), len(pair)).astype(np.int64)
            held[:], weight[:] = [pair], [docs]
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(docs)], schema=schema)

        for b in batches:
            pairs, sizes = _pairs_of(b.column(0).to_pylist())
            held.append(pairs)
            weight.append(np.repeat(np.array(b.column(1).to_pylist(), np.int64), sizes))
            size += len(pairs)
            if size >= HOLD_PAIRS:
                out = flush()
                size = len(held[0])
                if 2 * size >= HOLD_PAIRS:  # mostly different ones: pass them on
                    yield out
                    held, weight, size = [], [], 0
        if held:
            yield flush()

    counts = texts.select("pairs", "rows").mapInArrow(count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = counts.select("pair", F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "docs")
    # An A id has at most as many pairs as B has ids.
    counts = counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))
    counts.write.mode("overwrite").parquet(f"{folder}/pairs")
    return texts.sparkSession.read.parquet(f"{folder}/pairs")


def text_measures(texts: DataFrame, pairs: DataFrame, folder: str, heavy: int = HEAVY) -> DataFrame:
    """Per distinct text: hash, the four sums, groups_sha256, n_best and count_sum."""
    spark = texts.sparkSession
    top = pairs.select("pair", "docs", "best").orderBy(F.desc("docs"), "pair").limit(heavy).toArrow()
    known = [top.column(c).to_numpy() for c in ("pair", "docs", "best")]
    order = np.argsort(known[0], kind="stable")
    table_of = spark.sparkContext.broadcast([x[order] for x in known])

    def look_up(cols: dict) -> dict:
        pair, docs, best = table_of.value
        own, sizes = _pairs_of(cols["pairs"])
        links, _ = _pairs_of(cols["links"])
        n = len(sizes)
        text = np.repeat(np.arange(n), sizes)
        at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
        hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
        by, weight, at = text[hit], links[hit], at[hit]
        out = cols.rest()
        # bincount adds doubles: whole numbers stay exact below 2**53
        out["n_best"] = np.bincount(by, weight * best[at], n).astype(np.int64)
        out["count_sum"] = np.zeros(n, np.int64)
        np.add.at(out["count_sum"], by, weight * docs[at])
        cuts = np.searchsorted(text[~hit], np.arange(n + 1))
        out["rare"], out["times"] = ([x[~hit][cuts[i]:cuts[i + 1]] for i in range(n)] for x in (own, links))
        return out

    plain = "h1 long, h2 long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    schema = f"{plain}, n_best long, count_sum long, rare array<long>, times array<long>"
    map_batches(texts.drop("rows"), look_up, schema).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/looked_up")
    part = spark.read.parquet(f"{folder}/looked_up")
    rare = part.where(F.size("rare") > 0).select("h1", "h2", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select("h1", "h2", F.col("x.rare").alias("pair"), F.col("x.times").alias("times")).join(pairs.select("pair", "docs", "best"), "pair")
    rare = rare.groupBy(F.col("h1").alias("r1"), F.col("h2").alias("r2")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    both = part.drop("rare", "times").join(rare, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")), "left")
    return both.select("h1", "h2", "n_a", "n_b", "n_groups", "n_links",
                       (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                       (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def align(docs: DataFrame, a_path: str, b_path: str, folder: str, heavy: int = HEAVY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key and the measures of its text. ``folder`` keeps the tables texts and pairs (the alignment itself)."""
    with open(a_path, encoding="utf-8") as f:
        spec = f.read()
    with open(b_path, "rb") as f:
        model = f.read()
    texts = align_texts(docs, spec, model, folder, text)
    pairs = pair_table(texts, Aligner(spec, model).width, folder)
    once = text_measures(texts, pairs, folder, heavy)
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(t).alias("d1"), F.xxhash64(F.lit(1), t).alias("d2"))
    joined = rows.join(once, (F.col("d1") == F.col("h1")) & (F.col("d2") == F.col("h2")), "left")
    sums = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return joined.select(F.col("k").alias(key), *sums, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents")
    return align(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), scratch_path(spark, f"align-{uuid.uuid4().hex}"))
