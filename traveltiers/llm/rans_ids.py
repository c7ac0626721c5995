"""Operator 8: token ids in a file format of static range asymmetric numeral systems.

Documents are ordered by id (range partitions, sorted within), tokenised once and kept as a
table of ids. One frequency table over all ids is shared by every block. A block holds whole
documents, about BLOCK_IDS ids or one longer document, and is coded by itself: LANES
interleaved coder states share one stream of 32-bit words, a checkpoint (states and stream
position) stands before every STEP_IDS ids so that one block's parts decode in parallel, and
a checksum covers the ids. The blocks are the rows of Parquet files, written and read by
Spark's own writers, so they go to any store that the cluster shares.

Order of the result: ascending id, rows of one id by the hash of their text; null ids first.
Null or empty text: the end id alone. An empty table gives no blocks and an empty result.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traveltiers.llm.common import arrow_schema, map_batches, remember, table
from traveltiers.session import scratch_path

END_ID = 2
LANES = 1024
BLOCK_IDS = 1 << 17
STEP_IDS = 1 << 16
SCALE = 20  # frequencies sum to 2**SCALE
LOW = np.uint64(1 << 31)  # states stay in [LOW, LOW << 32)
#: Runs that a worker remembers (some 150 MB); 24 batches of 512 documents held 670,000 distinct ones.
MEMO = 1_000_000
#: Runs of whole texts that are gathered at once.
HOLD_RUNS = 500_000
#: Runs of letters that go to the library as one string.
JOINED = 2048


# ---------------------------------------------------------------- coder

class Coder:
    """The shared tables: frequency and start of each id, and the id of each slot."""

    def __init__(self, counts: np.ndarray):
        self.freq = scaled(counts)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> dict:
        """One block: final states, words, checkpoints, checksum."""
        n = len(ids)
        steps = -(-n // LANES)
        per = STEP_IDS // LANES
        grid = np.zeros(steps * LANES, np.int64)
        grid[:n] = ids
        f, c = self.freq[grid].reshape(steps, LANES), self.start[grid].reshape(steps, LANES)
        state = np.full(LANES, LOW, np.uint64)
        words, marks, written = [], [], 0
        for s in range(steps - 1, -1, -1):
            width = min(LANES, n - s * LANES)  # the last row may be short; its other lanes rest
            x, fs, cs = state[:width], f[s, :width], c[s, :width]
            full = x >= (fs << np.uint64(63 - SCALE))
            if full.any():
                words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                written += len(words[-1])
                x = np.where(full, x >> np.uint64(32), x)
            state[:width] = ((x // fs) << np.uint64(SCALE)) + x % fs + cs
            if s and s % per == 0:
                marks.append((s * LANES, written, state.astype("<u8").tobytes()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        return {"n_ids": n, "states": state.astype("<u8").tobytes(), "stream": stream.tobytes(),
                "mark_at": [m[0] for m in marks[::-1]], "mark_word": [written - m[1] for m in marks[::-1]],
                "mark_states": [m[2] for m in marks[::-1]], "checksum": zlib.crc32(np.asarray(ids, "<u4").tobytes())}

    def decode_part(self, block: dict, part: int) -> np.ndarray:
        """The ids from checkpoint ``part`` (0: the block's start) to the next one."""
        at, word, states = [0, *block["mark_at"]], [0, *block["mark_word"]], [block["states"], *block["mark_states"]]
        stop = at[part + 1] if part + 1 < len(at) else block["n_ids"]
        stream, pos = np.frombuffer(block["stream"], "<u4").astype(np.uint64), word[part]
        state = np.frombuffer(states[part], "<u8").astype(np.uint64)
        out = np.empty(stop - at[part], np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for i in range(0, len(out), LANES):
            width = min(LANES, len(out) - i)
            x = state[:width]
            slot = x & mask
            ids = self.slot[slot.astype(np.int64)]
            out[i:i + width] = ids
            x = self.freq[ids] * (x >> np.uint64(SCALE)) + slot - self.start[ids]
            low = x < LOW
            k = int(low.sum())
            if k:
                x[low] = (x[low] << np.uint64(32)) | stream[pos:pos + k]
                pos += k
            state[:width] = x
        return out

    def decode(self, block: dict) -> np.ndarray:
        """All ids of a block, held against its checksum."""
        ids = np.concatenate([self.decode_part(block, k) for k in range(1 + len(block["mark_at"]))]) if block["n_ids"] else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["checksum"]:
            raise ValueError("a block's ids don't match its checksum")
        return ids


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 for every id that occurs."""
    total = 1 << SCALE
    counts = np.asarray(counts, np.float64)
    if not counts.sum():
        counts = np.ones(len(counts))
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts / counts.sum() * total)), 0).astype(np.int64)
    over = int(freq.sum()) - total
    order = np.argsort(-freq, kind="stable")
    if over <= 0:
        freq[order[0]] -= over
    while over > 0:  # ids raised to 1 are paid for by the frequent ones
        for i in order:
            take = min(over, int(freq[i]) // 2)
            freq[i] -= take
            over -= take
            if not over:
                break
    return freq.astype(np.uint64)


# ---------------------------------------------------------------- tokeniser

class Codes(dict):
    """Numbers of runs in the order in which they appear; ``new`` holds those without ids so far."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, run: str) -> int:
        self[run] = out = len(self)
        self.new.append(run)
        return out


#: Latin letters that no normal form composes and that have one letter as lower case (all up to U+024F but U+0130).
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


#: The letters that byte-level vocabularies write for bytes: printable Latin-1 stands for itself, the others follow from U+0100 on; here a space stays one.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = np.arange(256, dtype="<u2")
_BYTE_LETTERS[[b for b in range(256) if b not in _PRINTED]] = range(256, 512 - len(_PRINTED))
_BYTE_LETTERS[32] = 32


def byte_letters(text: str) -> str:
    """A text's UTF-8 bytes as byte letters, with its spaces."""
    return text if text.isascii() else _BYTE_LETTERS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def quick_encoder(spec: str):
    """``encode_batch`` of the file's model alone, for runs of lower-case Latin letters in byte letters with a space between, and
    which ids end a run; None if the file has other steps than these.

    Normal form, white space and lower case leave such a run as it is, and the split takes it whole. The model marks a run's
    last piece, so one call gives the ids of many runs in a row. The byte letters of ASCII letters are themselves; ``byte_letters``
    spells the others.
    """
    from tokenizers import Tokenizer

    parts = json.loads(spec)
    steps = [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])]
    cuts = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    mark = parts["model"].get("end_of_word_suffix")
    if steps != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in cuts] != ["Split", "ByteLevel"] or parts.get("post_processor") or not mark:
        return None
    split = cuts[0]
    if split.get("behavior") != "Removed" or not split.get("invert") or "|[\\p{L}]+|" not in split["pattern"].get("Regex", "") or cuts[1].get("use_regex") or cuts[1].get("add_prefix_space"):
        return None
    apart = {"type": "WhitespaceSplit"}
    quick = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": apart, "added_tokens": [], "truncation": None, "padding": None}))
    vocab = parts["model"]["vocab"]
    last = np.zeros(1 + max(vocab.values()), bool)
    last[[i for piece, i in vocab.items() if piece.endswith(mark)]] = True
    return getattr(quick, "encode_batch_fast", quick.encode_batch), last


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a row, and how many each list has."""
    return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))


def gather(ids: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``n`` ids from ``start`` on, in a row."""
    ends = np.cumsum(n)
    return ids[np.repeat(start - ends + n, n) + np.arange(ends[-1])] if len(ends) else ids[:0]


class Ids:
    """Ids of texts by a tokenizers file; each run between ASCII white space is encoded once while remembered.

    The file's normaliser and pre-tokeniser never join across white space and lower-case
    character by character, so a text's ids are those of its runs in a row.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.fast = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        self.quick = quick_encoder(spec)
        self.special = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.reset()

    def reset(self) -> None:
        """Forget all runs. The ids of run number c are ids[offsets[c]:offsets[c + 1]]; the empty run, number 0, is the end id."""
        self.codes = Codes({"": 0})
        self.ids, self.offsets = np.array([END_ID], np.uint32), np.array([0, 1])

    def raw(self, runs: list[str]) -> list[list[int]]:
        return [e.ids for e in self.fast(runs, add_special_tokens=False)]

    def letters(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row, and their number a run, of runs of lower-case Latin letters: the file's model without the steps that leave them as they are."""
        if self.quick and runs:
            encode, last = self.quick
            joined = encode([byte_letters(" ".join(runs[i:i + JOINED])) for i in range(0, len(runs), JOINED)], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in joined])
            ends = np.flatnonzero(last[ids])
            if len(ends) == len(runs):
                return ids, np.diff(ends, prepend=-1)
        return flat(self.raw(runs))

    def learn(self) -> None:
        """Encode the runs that have a number and no ids yet."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        # Letters without their closing mark, lower-cased: one entry serves the word's other forms. Other ASCII is lower-cased
        # too, unless that would make an added token. A run is two pieces; letters are numbered from 0, others from -1 down.
        column = pa.array(new, pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[1:len(new) + 1]
        closing = np.frombuffer(column.buffers()[2], np.uint8)[ends - 1]
        marked = (closing == ord(",")) | (closing == ord("."))
        base = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(column, 0, -1), column)
        ascii_word = pc.ascii_is_alpha(base)
        at = np.flatnonzero(ascii_word.to_numpy(zero_copy_only=False))
        coded = pc.ascii_lower(base.take(pa.array(at))).dictionary_encode()
        letters, others = dict.fromkeys(strings(coded.dictionary)), {"": -1, ",": -2, ".": -3}
        first, second = np.zeros(len(new), np.int64), np.full(len(new), -1, np.int64)
        first[at] = coded.indices.to_numpy()
        second[at] = np.where(marked[at], np.where(closing[at] == ord(","), -2, -3), -1)
        for i in np.flatnonzero(~ascii_word.to_numpy(zero_copy_only=False)).tolist():  # ASCII words are done; no other lower-cases to one
            r = new[i]
            own, mark = (r[:-1], r[-1]) if r[-1] in ",." else (r, "")
            if _LATIN.fullmatch(own):
                first[i] = letters.setdefault(own.lower(), len(letters))
                second[i] = others[mark]
            else:
                low = r.lower() if r.isascii() else r
                if any(s in low for s in self.special):
                    low = r
                first[i] = others.setdefault(low, -1 - len(others))
        ids, sizes = zip(self.letters(list(letters)), flat([[], *self.raw(list(others)[1:])]))
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        piece = np.array([first, second]).T.ravel()
        piece = np.where(piece < 0, len(letters) - 1 - piece, piece)
        n = sizes[piece]
        self.ids = np.concatenate([self.ids, gather(ids, (np.cumsum(sizes) - sizes)[piece], n)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(n.reshape(-1, 2).sum(1))])

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if t and any(s in t for s in self.special):  # an added token's string: the library handles the whole text
                out[i] = np.array(self.raw([t])[0] + [END_ID], np.uint32)
            else:
                plain.append(i)
        if not plain:
            return out
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array([texts[i] or "" for i in plain], pa.large_string())))
        runs, sizes = pc.list_flatten(split), pc.list_value_length(split).to_numpy()  # a text without runs: one empty run
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < len(plain):
            begin = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + HOLD_RUNS, "right")))
            self.fill(out, plain[first:last], runs.slice(begin, ends[last - 1] - begin), ends[first:last] - begin)
            first = last
        return out

    def fill(self, out: list, rows: list[int], runs: pa.Array, ends: np.ndarray) -> None:
        """The ids of the rows' texts, gathered from the table of runs in one step; ``ends``: where each text's runs end. Each distinct run is looked up once."""
        if len(self.codes) > MEMO:
            self.reset()
        coded = runs.dictionary_encode()
        number = np.fromiter(map(self.codes.__getitem__, strings(coded.dictionary)), np.int64, len(coded.dictionary))
        self.learn()
        code = number[coded.indices.to_numpy()]
        n = self.offsets[code + 1] - self.offsets[code]
        n[code == 0] = 0  # the empty run is the end id, which every text gets below
        ids, stops = gather(self.ids, self.offsets[code], n), np.cumsum(n)[ends - 1]
        own = np.split(np.insert(ids, stops, END_ID), (stops + np.arange(1, len(stops) + 1))[:-1])
        for i, x in zip(rows, own):
            out[i] = x


_tokenisers: dict[int, Ids] = {}
remember(__name__, _tokenisers)


def tokeniser(spec: str) -> Ids:
    """One tokeniser a worker process and file, kept between tasks."""
    key = hash(spec)
    if key not in _tokenisers:
        _tokenisers.clear()
        _tokenisers[key] = Ids(spec)
    return _tokenisers[key]


# ---------------------------------------------------------------- files

BLOCK = "n_ids long, states binary, stream binary, mark_at array<long>, mark_word array<long>, mark_states array<binary>, checksum long"


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, text: str = "text", key: str = "doc_id") -> None:
    """Tokenise, order and write ``docs`` under ``folder``: ids/ (staged), counts/, blocks/ (part, block, keys, lengths and the block)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    named = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = named.repartitionByRange(parts, "k", "h").sortWithinPartitions("k", "h")

    def tokenise(cols: dict, own: Ids) -> dict:
        ids = own.of(cols["t"])
        return {"seq": cols["seq"], "k": cols["k"], "n": [len(x) for x in ids], "ids": [x.astype("<u4").tobytes() for x in ids]}

    # seq: the range partition above bit 33 and the row's number in it below, so it rises with the order.
    staged = map_batches(ordered.select(F.monotonically_increasing_id().alias("seq"), "k", "t"), tokenise, "seq long, k long, n long, ids binary",
                         lambda: tokeniser(spec.value))
    staged.write.mode("overwrite").parquet(f"{folder}/ids")

    def count(batches: Iterator) -> Iterator:
        total = np.zeros(1, np.int64)
        for b in batches:
            got = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4"))
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "times"])

    ids = spark.read.parquet(f"{folder}/ids")
    ids.select("ids").mapInArrow(count, "id long, times long").groupBy("id").agg(F.sum("times").alias("times")).write.mode("overwrite").parquet(f"{folder}/counts")
    tables = spark.sparkContext.broadcast(_counts(spark, folder))

    kinds = f"part long, seq long, keys array<long>, lengths array<long>, {BLOCK}"
    schema = arrow_schema(kinds)

    def blocks(batches: Iterator) -> Iterator:
        coder = Coder(tables.value)
        first, keys, lengths, held, size = 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            row = {"part": first >> 33, "seq": first, "keys": keys, "lengths": lengths} | coder.encode(np.concatenate(held))
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            for seq, k, n, data in zip(*(b.column(i).to_pylist() for i in range(4))):
                if held and (seq != first + len(held) or size + n > BLOCK_IDS):  # full, or the next piece of another file
                    yield close()
                    keys, lengths, held, size = [], [], [], 0
                if not held:
                    first = seq
                keys.append(k)
                lengths.append(n)
                held.append(np.frombuffer(data, "<u4"))
                size += n
        if held:
            yield close()

    ids.mapInArrow(blocks, kinds).write.mode("overwrite").option("compression", "none").parquet(f"{folder}/blocks")


def _counts(spark, folder: str) -> np.ndarray:
    """The shared table of counts, as long as the vocabulary."""
    got = spark.read.parquet(f"{folder}/counts").collect()
    out = np.zeros(1 + max((r["id"] for r in got), default=0), np.int64)
    for r in got:
        out[r["id"]] = r["times"]
    return out


def read_ids(spark, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32, and with ``with_ids`` the ids.

    ``start`` adds the ids of earlier parts (one sum a part reaches the driver), of earlier
    blocks of the part and of earlier documents of the block.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    tables = spark.sparkContext.broadcast(_counts(spark, folder))
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, run = {}, 0
    for r in totals:
        before[r["part"]], run = run, run + r["n"]
    w = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select("part", "seq", "n_ids").withColumn("ahead", F.coalesce(F.sum("n_ids").over(w), F.lit(0))).select("seq", "ahead")
    placed = blocks.join(ahead, "seq")
    offsets = spark.sparkContext.broadcast(before)
    names = [f.split()[0] for f in BLOCK.split(", ")]

    def run(cols: dict, coder: Coder) -> dict:
        out: dict = {"k": [], "start": [], "n_tokens": [], "ids_crc32": []}
        if with_ids:
            out["ids"] = []
        for i, part in enumerate(cols["part"]):
            ids = coder.decode({n: cols[n][i] for n in names})
            pos = 0
            start = offsets.value[part] + cols["ahead"][i]
            for k, n in zip(cols["keys"][i], cols["lengths"][i]):
                own = ids[pos:pos + n].astype("<u4")
                out["k"].append(k)
                out["start"].append(start + pos)
                out["n_tokens"].append(n)
                out["ids_crc32"].append(zlib.crc32(own.tobytes()))
                if with_ids:
                    out["ids"].append(own.astype(np.int64))
                pos += n
        return out

    schema = "k long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return map_batches(placed, run, schema, lambda: Coder(tables.value)).withColumnRenamed("k", key)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    folder = scratch_path(spark, f"rans-{uuid.uuid4().hex}")
    write_ids(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"), folder)
    return read_ids(spark, folder)
