"""Operator 10: n-gram Jaccard join, size-aware, heavy-light, with connected components.

A document's set is its distinct 5-word shingles (A-Z lower-cased), counted as 64-bit hashes and joined
as their upper 48 bits (two of the thousand or so shingles of a pair collide in one of some 10**8 pairs). Two
sets link when 100 * |both| >= 80 * |either|. The steps:

1. Equal sets are one class (by a 96-bit signature); classes, not documents, are joined.
2. Shingles that a task sees in several sets are counted; the HEAVY_TABLE most frequent
   ones form the heavy table (a bounded broadcast; it only orders shingles, so it changes
   cost and never results). All sets order their shingles alike: light ones first, by hash,
   then heavy ones by rising count.
3. Linked sets of size a <= b share at least ceil(0.8 b) shingles, so they share at least
   SUBSET of the first floor(0.2 n) + SUBSET of each (unequal sets that link share four at
   least). Small sets enumerate all subsets of SUBSET shingles of that prefix; large sets scan the
   inverted lists of its single shingles, in which small sets near the border are listed too, and
   a pair must meet in SUBSET lists. The border is the size with the least cost: subsets
   written for small sets against postings times the length of the lists that they scan.
4. Within a list every class is held against the list's first class (a star, linear in the
   list), and where the list is long, against the BEFORE classes before it as well, which leaves
   few components of a dense group. Classes that this doesn't bring together are then held against all
   others of the list that are in another component, so no link between components is missed.
5. A set's sketch is the parity of its shingles in each of 64 * SKETCH buckets. Two sketches
   differ in at most as many bits as the sets in shingles, so a pair whose sketches differ in
   more than linked sets may is refuted, exactly, before it is written.
6. Pairs are verified on the whole sets, between components the likeliest pair of every two first, and
   then all that still lie in different ones; components come from repeated minimum labels with
   pointer jumping.

Null or empty texts, and texts without words, have empty sets and link with nothing. Fewer
than five words: the whole sequence is the one shingle. A row without an id takes part in
no component (null). Rows repeat as in the input; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from traveltiers.llm.common import batch_rows, map_batches, remember, table, tidy, words
from traveltiers.llm.common import restart as cut

OWNER = __name__
WIDTH, PERCENT = 5, 80
SUBSET = 3
HEAVY_TABLE = 1 << 18
#: Shingles that a task holds while it looks for repeated ones.
HEAVY_HOLD = 1 << 21
#: Upper bits of a shingle by which the table's last ones are told among those of one count.
TIE_BITS = 16
#: Entries from which a list is dealt over salts, one for so many.
LONG_LIST = 5_000
#: In lists of more classes than MANY each class is held against the BEFORE ones before it, before components are met.
MANY, BEFORE = 8, 16
_LOWER = {i: i + 32 for i in range(65, 91)}
BYTES = 6
#: Bytes of a set's signature: at 10**10 sets, two different ones share it with a chance of about 10**-9.
SIGNATURE = 12
#: Words of 64 bits of a set's sketch.
SKETCH = 8
#: Bits of the map of signatures whose sets are needed again; it only spares work.
WANTED_BITS = 24
MARKS = [f"k{i}" for i in range(SKETCH)]
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out


_hashes = Hashes()
remember(OWNER, _hashes)


def shingles(text: str | None) -> np.ndarray:
    """The set of a text: sorted distinct 64-bit hashes."""
    ws = words(text.translate(_LOWER) if text and not text.isascii() else text.lower() if text else text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, ws), np.uint64, len(ws))
    if len(ws) < WIDTH:
        x = np.full(1, len(ws), np.uint64)
        for v in h:
            x = mixed(x + v)
        return x
    x = np.zeros(len(h) - WIDTH + 1, np.uint64)
    for k in range(WIDTH):
        x = mixed(x + h[k:len(h) - WIDTH + 1 + k])
    return np.unique(x)


def shortened(x: np.ndarray) -> np.ndarray:
    """The upper 8 * BYTES bits of sorted hashes, in the same order, each once."""
    x = x >> np.uint64(64 - 8 * BYTES)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def packed(x: np.ndarray) -> bytes:
    """Hashes as BYTES bytes each."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // BYTES, 8), np.uint8)
    out[:, :BYTES] = np.frombuffer(data, np.uint8).reshape(-1, BYTES)
    return out.view("<u8").ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def sketch(x: np.ndarray) -> np.ndarray:
    """The parity of the hashes in each of 64 * SKETCH buckets, as SKETCH integers."""
    odd = np.bincount((x % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def text_hash(text: str):
    """128 bits of a text; null for null."""
    return F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))


def sets(docs: DataFrame, text: str = "text", key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Per row: id, sig (of the set), n (its size), total (its size by 64-bit hashes), k0, k1, ... (its sketch), shingles (the sorted hashes as bytes), and ``with_text`` th, the text's hash."""
    named = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"), *[text_hash(text).alias("th")] * with_text)

    def run(cols: dict) -> dict:
        whole = [shingles(t) for t in cols["t"]]
        short = [shortened(x) for x in whole]
        data = [packed(x) for x in short]
        marks = np.array([sketch(x) for x in short], np.int64).reshape(-1, SKETCH)
        return cols | {name: pa.array(marks[:, i]) for i, name in enumerate(MARKS)} | {"sig": [blake2b(d, digest_size=SIGNATURE).digest() for d in data], "n": [len(d) // BYTES for d in data], "total": [len(x) for x in whole], "shingles": data}

    return map_batches(named, run, "id long, " + "th binary, " * with_text + "sig binary, n int, total int, " + "".join(f"{name} long, " for name in MARKS) + "shingles binary")


def heavy_table(spark: SparkSession, staged: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted) and their counts, from repeats that tasks see among different sets."""

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(OWNER)
        held: dict[bytes, np.ndarray] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            got, count = np.unique(np.concatenate(list(held.values())), return_counts=True)
            twice = count > 1
            return pa.RecordBatch.from_arrays([pa.array(got[twice].view(np.int64)), pa.array(count[twice].astype(np.int64))], names=["h", "c"])

        for b in batches:
            for sig, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if sig not in held:
                    held[sig] = unpacked(data)
                    size += len(held[sig])
                if size >= HEAVY_HOLD:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    counted = staged.filter("n > 0").select("sig", "shingles").mapInArrow(repeats, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).persist(StorageLevel.DISK_ONLY)
    top = most_frequent(counted, HEAVY_TABLE).toArrow()  # bounded: HEAVY_TABLE rows, and the ties of one bucket
    counted.unpersist()
    h, c = top["h"].to_numpy(), top["c"].to_numpy()
    first = np.lexsort((h, -c))[:HEAVY_TABLE]
    h, c = h[first].view(np.uint64), c[first]
    order = np.argsort(h)
    return h[order], c[order]


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows (h, c) of the greatest c, then the least h, and some more of the last c: few enough to be collected.

    The last row's place is told from counts of rows; a sort with a limit would send the driver up to ``most`` rows from each task.
    """
    def passed(rows: DataFrame, by: str, left: int, falling: bool) -> tuple[int | None, int]:
        """The value of ``by`` at which so many rows are reached, and those left for it; None where there are no more."""
        counts = rows.groupBy(F.expr(by).alias("v")).agg(F.count("*").alias("rows")).toArrow()
        v, times = counts["v"].to_numpy(), counts["rows"].to_numpy()
        order = np.argsort(-v if falling else v)
        before = np.cumsum(times[order])
        at = int(np.searchsorted(before, left))
        if at == len(before):
            return None, left
        return int(v[order][at]), left - int(before[at] - times[order][at])

    least, left = passed(counted, "c", most, True)  # the values of c are few: n of them stand for n * n / 2 repeats
    if least is None:
        return counted
    ties, _ = passed(counted.filter(F.col("c") == least), f"shiftright(h, {8 * BYTES - TIE_BITS})", left, False)
    return counted.filter((F.col("c") > least) | ((F.col("c") == least) & (F.shiftright("h", 8 * BYTES - TIE_BITS) <= ties)))


def least_shared(n: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-PERCENT * n // 100)


def border(sizes: dict[int, int], scan: float) -> int:
    """The largest size of small sets: least cost of subsets plus scanned postings over all sets."""
    best, at = None, 0
    top = max(sizes, default=0)
    for x in [0, *range(4, min(top, 400) + 1)]:
        cost = 0.0
        for n, times in sizes.items():
            prefix = n - least_shared(n) + 1
            if n <= x:
                cost += times * comb(prefix + SUBSET - 1, SUBSET)
            if n > x or 100 * n >= PERCENT * (x + 1):
                cost += times * (prefix + SUBSET - 1) * scan
        if best is None or cost < best:
            best, at = cost, x
    return at


@cache
def subsets(size: int) -> np.ndarray:
    """Indices of all subsets of SUBSET of so many."""
    return np.array(list(combinations(range(size), SUBSET)), np.int64).reshape(-1, SUBSET)


def postings(staged: DataFrame, heavy, small: int) -> DataFrame:
    """The lists' entries: key (of one shingle, or of a subset), salt, sig, n, rest (shingles from the key's first one on). The lists of very frequent shingles are dealt over salts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(OWNER)
        known, counts = heavy.value
        for b in batches:
            keys, salts, sigs, ns, rests = [], [], [], [], []
            for sig, n, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                s = unpacked(data)
                seen = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    seen = np.where(known[at] == s, counts[at], 0)
                    order = np.argsort(seen, kind="stable")
                    s, seen = s[order], seen[order]
                prefix = n - least_shared(n) + SUBSET
                own, deal, place = [], [], []
                if SUBSET <= n <= small:
                    at = subsets(min(n, prefix))
                    key = np.zeros(len(at), np.uint64)
                    for h in np.sort(s[at], axis=1).T:
                        key = mixed(key + h)
                    own.append(key | np.uint64(1))  # an odd key is a subset's
                    deal.append(seen[at].min(axis=1))
                    place.append(at[:, 0])
                if n > small or 100 * n >= PERCENT * (small + 1):
                    own.append(s[:prefix] << np.uint64(1))
                    deal.append(seen[:prefix])
                    place.append(np.arange(len(own[-1])))
                if own:
                    parts = np.concatenate(deal) // LONG_LIST  # 0: not dealt
                    keys.append(np.concatenate(own))
                    salts.append(np.where(parts > 0, 1 + int.from_bytes(sig[:4], "little") % np.maximum(parts, 1), 0).astype(np.int32))
                    sigs.extend([sig] * len(parts))
                    ns.append(np.full(len(parts), n, np.int32))
                    rests.append(n - np.concatenate(place).astype(np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(salts)), pa.array(sigs, pa.binary()), pa.array(np.concatenate(ns)), pa.array(np.concatenate(rests).astype(np.int32))], names=["key", "salt", "sig", "n", "rest"])

    return staged.filter("n > 0").select("sig", "n", "shingles").mapInArrow(run, "key long, salt int, sig binary, n int, rest int")


def shared_lists(entries: DataFrame, held: list[DataFrame]) -> DataFrame:
    """Lists with two classes or more that can link: key, sig, n, rest, head (the list's least class), hn, hrest. One shuffle; a task streams over its sorted lists. What is kept on disk is added to ``held``, to be given up when the lists have been read."""
    names = ["key", "salt", "sig", "n", "rest", "head", "hn", "hrest"]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32())

    def table_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = head = second = last = None  # second: waits to see whether the list has more than two
        out: list = []

        def close() -> None:
            """The end of a list: one of two classes whose sizes can't link is left out."""
            if second is not None and can_link(*head[1:], *second[1:]):
                out.append((*now, *head, *head))
                out.append((*now, *second, *head))

        for b in batches:
            key, salt = b.column(0).to_numpy(), b.column(1).to_numpy()
            start, fresh = np.ones(len(key), bool), np.ones(len(key), bool)
            start[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            sig = b.column(2)
            fresh[1:] = start[1:] | pc.not_equal(sig.slice(1), sig.slice(0, len(sig) - 1)).to_numpy(zero_copy_only=False)
            group = np.cumsum(start) - 1
            several = np.bincount(group, fresh) > 1
            several[[0, -1]] = True  # they may go on in another batch
            chosen = b.take(pa.array(np.flatnonzero(fresh & (several[group] | (salt > 0)))))
            for key, salt, *row in zip(*(chosen.column(i).to_pylist() for i in range(5))):
                if (key, salt) != now:
                    close()
                    now, head, second, last, long = (key, salt), row, None, row[0], False
                elif row[0] == last:
                    continue
                elif long:
                    out.append((*now, *row, *head))
                elif second is None and not salt:
                    second = row
                elif not salt:
                    long = True
                    out.extend((*now, *x, *head) for x in (head, second, row))
                    second = None
                last = row[0]
                if salt:  # a dealt list: its head is found over all salts
                    out.append((*now, *row, None, 0, 0))
            yield table_of(out)
            out.clear()
        close()
        yield table_of(out)

    found = entries.repartition("key", "salt").sortWithinPartitions("key", "salt", "sig").mapInArrow(run, "key long, salt int, sig binary, n int, rest int, head binary, hn int, hrest int")
    with batch_rows(entries.sparkSession, 16_384):
        found = found.persist(StorageLevel.DISK_ONLY)
        found.count()
    held.append(found)
    dealt = found.filter("salt > 0").select("key", "sig", "n", "rest")
    heads = dealt.groupBy("key").agg(F.min(F.struct("sig", "n", "rest")).alias("h"), F.count("*").alias("c")).filter("c > 1")
    dealt = dealt.join(heads, "key").select("key", "sig", "n", "rest", F.col("h.sig").alias("head"), F.col("h.n").alias("hn"), F.col("h.rest").alias("hrest"))
    return found.filter("salt = 0").select("key", "sig", "n", "rest", "head", "hn", "hrest").unionByName(dealt)


def neighbours(found: DataFrame) -> DataFrame:
    """Pairs (key, a, b) that may link, of each class of a long list and the BEFORE ones before it; ``found`` holds the lists, sorted.

    Linear in the lists. They lie as they were dealt, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, listed = None, 0
        last: deque = deque(maxlen=BEFORE)
        early: list = []  # pairs of the list's first classes, until it is known to be long
        for b in batches:
            keys, left, right = [], [], []
            for key, salt, *row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (key, salt) != now:
                    now, listed, early = (key, salt), 0, []
                    last.clear()
                listed += 1
                met = [(x[0], row[0]) for x in last if can_link(*x[1:], *row[1:])]
                if listed <= MANY:
                    early += met
                    met = []
                elif early:
                    met += early
                    early = []
                for x, y in met:
                    keys.append(key)
                    left.append(x)
                    right.append(y)
                last.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["key", "a", "b"])

    return found.select("key", "salt", "sig", "n", "rest").mapInArrow(run, "key long, a binary, b binary")


def wanted_bodies(staged: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """sig and shingles of the classes on one side, a or b, of the pairs (and of a few more), one row each.

    A map of the signatures' first bits drops the other sets where they lie; it has 2**WANTED_BITS bits at any size of the corpus.
    """
    at = F.conv(F.substring(F.hex("sig"), 1, WANTED_BITS // 4), 16, 10).cast("long")
    got = pairs.select(F.col(side).alias("sig")).select(at.alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v")).toArrow()
    words = np.zeros(1 << (WANTED_BITS - 6), np.int64)
    words[got["w"].to_numpy()] = got["v"].to_numpy()
    bits = staged.sparkSession.sparkContext.broadcast(words.view(np.uint8))  # 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array([int.from_bytes(s[:WANTED_BITS // 8], "big") for s in b.column(0).to_pylist()], np.int64)
            yield b.take(pa.array(np.flatnonzero(bits.value[p >> 3] >> (p & 7).astype(np.uint8) & 1)))

    return staged.filter("n > 0").select("sig", "shingles").mapInArrow(run, "sig binary, shingles binary").dropDuplicates(["sig"])


def fits(n: str, rest: str, n2: str, rest2: str):
    """Whether two sets that meet at a key can link, were it one of their first SUBSET common shingles.

    They have at most the shorter rest, and SUBSET - 1 shingles before it, in common. Linked sets
    pass in the lists of their first SUBSET common shingles, which is as many as they need.
    """
    return (100 * F.least(n, n2) >= PERCENT * F.greatest(n, n2)) & ((100 + PERCENT) * (F.least(rest, rest2) + SUBSET - 1) >= PERCENT * (F.col(n) + F.col(n2)))


def can_link(n: int, rest: int, n2: int, rest2: int) -> bool:
    """``fits`` of two rows."""
    return 100 * min(n, n2) >= PERCENT * max(n, n2) and (100 + PERCENT) * (min(rest, rest2) + SUBSET - 1) >= PERCENT * (n + n2)


def distance(marks: list[str], marks2: list[str]):
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(marks, marks2)), F.lit(0))


def near(n: str, n2: str, marks: list[str], marks2: list[str]):
    """Whether two sets of these sizes and sketches may link: linked ones differ in (100 - PERCENT) / (100 + PERCENT) of their shingles at most."""
    return (100 + PERCENT) * distance(marks, marks2) <= (100 - PERCENT) * (F.col(n) + F.col(n2))


def refuted_away(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches leave."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("sig").alias(side), F.col("n").alias(f"{side}n"), *[F.col(x).alias(f"{side}{x}") for x in MARKS]), side)
    return pairs.filter(near("an", "bn", [f"a{x}" for x in MARKS], [f"b{x}" for x in MARKS])).select("a", "b")


def across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs (a, b) whose classes lie in different components."""
    for side in ("a", "b"):
        pairs = pairs.select("a", "b", *[c for c in pairs.columns if c == "ca"]).join(comp.select(F.col("sig").alias(side), F.col("comp").alias(f"c{side}")), side, "left")
    return pairs.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def verify(pairs: DataFrame, staged: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole sets link."""
    left, right = (wanted_bodies(staged, pairs, side).select(F.col("sig").alias(side), F.col("shingles").alias(f"s{side}")) for side in ("a", "b"))

    def run(cols: dict) -> dict:
        ok = []
        for x, y in zip(cols["sa"], cols["sb"]):
            p, q = unpacked(x), unpacked(y)
            both = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
            ok.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        return {"a": cols["a"], "b": cols["b"], "ok": ok}

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return map_batches(joined, run, "a binary, b binary, ok boolean").filter("ok").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(sig, comp): the smallest signature reachable, for every signature that has a link.

    Each round a node takes the least label among its own and its neighbours', then the
    label of that label. Rounds are cut by a checkpoint.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("sig"), F.least("a", "m").alias("comp")))
    while True:
        seen = both.join(label.select(F.col("sig").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        low = label.join(seen.withColumnRenamed("a", "sig"), "sig").select("sig", "comp", F.least("comp", "m").alias("low"))
        jump = label.select(F.col("sig").alias("low"), F.col("comp").alias("far"))
        nxt = cut(low.join(jump, "low").select("sig", F.least("low", "far").alias("new"), (F.least("low", "far") != F.col("comp")).alias("moved")))
        label = nxt.select("sig", F.col("new").alias("comp"))
        if not nxt.filter("moved").limit(1).count():
            return label


def join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest id reachable by links)."""
    out = joined(docs, text, key)
    return out.select(F.col("id").alias(key), F.col("total").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"))


def joined(docs: DataFrame, text: str, key: str, with_text: bool = False) -> DataFrame:
    """Per row: id, sig, n, comp (the component's least signature), component (its least id), and ``with_text`` th."""
    spark = docs.sparkSession
    # Kept on the executors' disks while the join runs; a lost executor's part is made again from its documents.
    staged = sets(docs, text, key, with_text).persist(StorageLevel.DISK_ONLY)
    plain = cut(staged.drop("shingles"))
    classes = cut(plain.filter("n > 0").groupBy("sig", "n").agg(F.min("id").alias("least"), *[F.first(x).alias(x) for x in MARKS]))

    known, counts = heavy_table(spark, staged)
    heavy = spark.sparkContext.broadcast((known, counts))
    sizes = {r["n"]: r["c"] for r in classes.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count("*").alias("c")).collect()}
    # Prefixes avoid the heavy table, so a list that is scanned is no longer than the table's last count, once the table is full.
    scan = 1.0 + (float(counts.min()) if len(counts) == HEAVY_TABLE else 1.0)
    held = [staged]
    lists = shared_lists(postings(staged, heavy, border(sizes, scan)), held)
    met = F.sum(F.when(F.col("key") % 2 != 0, SUBSET).otherwise(1)) >= SUBSET

    star = lists.filter((F.col("sig") != F.col("head")) & fits("n", "rest", "hn", "hrest")).groupBy(F.col("head").alias("a"), F.col("sig").alias("b")).agg(met.alias("met")).filter("met").select("a", "b")
    star = cut(refuted_away(star, classes))
    links = cut(verify(star, staged))
    comp = components(links)
    # Where most pairs of a long list link, few components are left after this.
    wide = neighbours(held[-1]).groupBy("a", "b").agg(met.alias("met")).filter("met").select("a", "b")
    wide = cut(refuted_away(across(wide, comp).join(star, ["a", "b"], "left_anti"), classes))
    if wide.limit(1).count():
        star = star.unionByName(wide)
        links = links.unionByName(cut(verify(wide, staged)))
        comp = components(links)

    # Only lists with classes of several components go on; in those, every pair of two components is met.
    named = cut(lists.select("key", "sig", "n", "rest").join(comp, "sig", "left").withColumn("comp", F.coalesce("comp", "sig")))
    mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("key", "lo")
    mixed = cut(named.join(mixed, "key").withColumn("first", F.expr("comp = lo")).drop("lo").join(classes.select("sig", *MARKS), "sig"))
    apart = mixed.filter("not first").select("key", F.col("sig").alias("a"), F.col("n").alias("an"), F.col("rest").alias("ar"), F.col("comp").alias("ac"), *[F.col(x).alias(f"a{x}") for x in MARKS])
    others = mixed.select("key", F.col("sig").alias("b"), F.col("n").alias("bn"), F.col("rest").alias("br"), F.col("comp").alias("bc"), "first", *[F.col(x).alias(f"b{x}") for x in MARKS])
    # Both outside the list's least component: one order of the two is enough.
    possible = fits("an", "ar", "bn", "br") & near("an", "bn", [f"a{x}" for x in MARKS], [f"b{x}" for x in MARKS])
    pairs = (apart.join(others, (apart["key"] == others["key"]) & (F.col("ac") != F.col("bc")) & (F.col("first") | (F.col("a") < F.col("b"))) & possible)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.struct("ac", "bc")).otherwise(F.struct(F.col("bc").alias("ac"), F.col("ac").alias("bc"))).alias("of"), apart["key"], distance([f"a{x}" for x in MARKS], [f"b{x}" for x in MARKS]).alias("d"))
             .groupBy("a", "b").agg(met.alias("met"), F.first("of").alias("of"), F.first("d").alias("d")).filter("met").select("a", "b", "of.ac", "of.bc", "d"))
    more = cut(pairs.join(star.select("a", "b").unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti"))
    # The likeliest pair of every two components goes first; then the pairs that still lie in different ones.
    best = cut(more.groupBy(F.least("ac", "bc"), F.greatest("ac", "bc")).agg(F.min(F.struct("d", "a", "b")).alias("x")).select("x.a", "x.b"))
    final = comp
    for left in (lambda: best, lambda: cut(across(more.join(best, ["a", "b"], "left_anti"), final))):
        now = left()
        extra = cut(verify(now, staged)) if now.limit(1).count() else now
        if extra.limit(1).count():
            links = links.unionByName(extra)
            final = components(links)
    for kept in held:
        kept.unpersist()

    least = cut(classes.join(final, "sig", "left").select("sig", "least", F.coalesce("comp", "sig").alias("comp")))
    roots = least.groupBy("comp").agg(F.min("least").alias("component"))
    member = cut(least.join(roots, "comp").select("sig", "comp", "component"))
    return plain.join(member, "sig", "left").withColumn("component", F.when(F.col("id").isNotNull(), F.col("component")))


def keep_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: the one with the least id (null comes last), then signature; rows without words stay.

    Rows are told apart by id and text, so the texts of one id, or of no id, are judged one by
    one. Repeats of a row in both go.
    """
    names = tuple(docs.columns)
    rows = joined(docs, text, key, with_text=True).filter("n > 0")
    # One entry for an id and text; from here on no key is held by many.
    held = cut(rows.groupBy("id", "th", "sig", "comp").count())
    first = held.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sig", "th")).alias("x"))
    first = cut(first.select(F.col("x.id").alias("kid"), F.col("x.th").alias("kth")))
    of_first = held["id"].eqNullSafe(first["kid"]) & (held["th"] == first["kth"])
    gone = held.join(first, of_first, "left_anti").select("id", "th")
    again = cut(held.filter("count > 1").join(first, of_first, "left_semi").select("id", "th"))
    own = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], F.col(f"`{key}`").cast("long").alias("__id"), text_hash(text).alias("__th"))

    def met(left: DataFrame, right: DataFrame):
        return left["__id"].eqNullSafe(right["id"]) & (left["__th"] == right["th"])

    stay = own.join(gone, met(own, gone), "left_anti")
    if again.limit(1).count():
        once = stay.join(again, met(stay, again), "left_semi").dropDuplicates(["__id", "__th"])
        stay = stay.join(again, met(stay, again), "left_anti").unionByName(once)
    return stay.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n i ON i.doc_id = a JOIN n j ON j.doc_id = b WHERE 100 * shared >= 80 * (i.n + j.n - shared)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.root)::BIGINT AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""
