"""Operator 11: periodic runs of words, by an online diagonal DP over active lags.

Words are read one after the other. An active lag d has a match length: how many words up to
the current one, without a gap, equal the word d before. Each word raises the lengths of the
active lags whose earlier word it equals and ends the others; a lag that ends with a length of
at least max(min_length - d, (min_exponent - 1) * d) gives the run at once (its stretch is the
matched words and the d before them). State is the active lags, not a table.

Which earlier occurrences may open a lag: not every one, as their number is quadratic for
frequent words, but those that can belong to a run. In a run of smallest period q, each stretch
of k >= q words that lies at least q words after the run's start last occurred exactly q words
before (a nearer occurrence would give a smaller period, by the theorem of Fine and Wilf), and
for exponent 3 one such k is 16 (q <= 16) or the power of two next above q. So for k = 16, 32,
... a word opens the lag to the latest earlier place where the k words up to it stand, if that
lag is at most k. Equal stretches are found by 64-bit hashes of words; lags are counted on the
words themselves, so a collision costs time and never a result. Most texts hold no stretch of 16
words twice and are done after one look. Time is about n log n for n words, also where one
word fills the text.

Null and empty texts: no words, no runs. Repeated rows repeat in the result; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import map_batches, table, words

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Shortest stretch that is looked up: below it no lag can have min_length and min_exponent (checked in ``Finder``).
BASE = 16
#: Words of whole texts that are looked at together.
HOLD_WORDS = 400_000

Run = tuple[int, int, int]  # start, length, period


def _mix(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Hashes of stretches of 2k words from those of their halves."""
    out = right * np.uint64(0x9E3779B97F4A7C15) + left * np.uint64(0xC2B2AE3D27D4EB4F)
    return out ^ (out >> np.uint64(29))


class Finder:
    """Runs of at least ``min_length`` words and ``min_exponent`` periods."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        if min_exponent < 3:
            raise ValueError("the lags that are opened are enough for three periods or more")
        if any(max(min_length, min_exponent * q) < BASE + q for q in range(1, BASE + 1)):
            raise ValueError(f"runs this short may hold no stretch of {BASE} words twice")
        self.min_length, self.min_exponent = min_length, min_exponent

    def of(self, texts: list[list[str]]) -> Iterator[list[Run]]:
        """Runs of each text's words, by start."""
        held, size = [], 0
        for w in texts:
            held.append(w)
            size += len(w)
            if size >= HOLD_WORDS:
                yield from self.block(held)
                held, size = [], 0
        if held:
            yield from self.block(held)

    def block(self, texts: list[list[str]]) -> list[list[Run]]:
        out: list[list[Run]] = [[] for _ in texts]
        sizes = np.array([len(w) for w in texts])
        ends = np.cumsum(sizes)
        flat = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(ends[-1])).view(np.uint64)
        if len(flat) < BASE:
            return out
        k = 1
        while k < BASE:  # stretches that reach into the text before are left out below
            flat = np.concatenate([flat[:k], _mix(flat[k:], flat[:-k])])
            k *= 2
        doc = np.repeat(np.arange(len(texts)), sizes)
        whole = np.arange(len(flat)) - (ends - sizes)[doc] >= BASE - 1
        marked = flat[whole] ^ (doc[whole].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        held = np.sort(marked)
        twice = np.unique(held[1:][held[1:] == held[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, marked), len(twice) - 1)
            for i in np.unique(doc[whole][twice[at] == marked]).tolist():
                out[i] = self.diagonals(texts[i], self.openings(flat[ends[i] - sizes[i]:ends[i]]))
        return out

    def openings(self, grams: np.ndarray) -> list[tuple[int, int]]:
        """(place, lag), by place: where a lag may open. ``grams`` are the hashes of the BASE words up to each place."""
        n, k, found = len(grams), BASE, []
        while 2 * n >= self.min_exponent * k or k == BASE:
            own = grams[k - 1:]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            if not same.any():
                break
            place, lag = order[1:][same] + k - 1, order[1:][same] - order[:-1][same]
            near = lag <= k
            if near.any():
                place, lag = place[near], lag[near]
                by = np.lexsort((place, lag))
                place, lag = place[by], lag[by]
                fresh = np.ones(len(place), bool)  # the next place of the same lag finds it open
                fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
                found += zip(place[fresh].tolist(), lag[fresh].tolist())
            if 2 * k > n:
                break
            grams = np.concatenate([grams[:k], _mix(grams[k:], grams[:-k])])
            k *= 2
        return sorted(set(found))

    def diagonals(self, w: list[str], opened: list[tuple[int, int]]) -> list[Run]:
        """The DP: match lengths of the active lags, word by word; ends give runs."""
        active: dict[int, int] = {}
        runs: dict[tuple[int, int], int] = {}  # stretch -> period

        def end(lag: int, stop: int) -> None:
            got = active.pop(lag)
            if got >= max(self.min_length - lag, (self.min_exponent - 1) * lag):
                stretch = (stop - got - lag, got + lag)
                runs[stretch] = min(lag, runs.get(stretch, lag))

        n, nxt, i = len(w), 0, 0
        while active or nxt < len(opened):
            if not active:
                i = opened[nxt][0]
            if i == n:
                for lag in list(active):
                    end(lag, n)
                break
            word = w[i]
            for lag in list(active):
                if w[i - lag] == word:
                    active[lag] += 1
                else:
                    end(lag, i)
            while nxt < len(opened) and opened[nxt][0] == i:
                lag, got = opened[nxt][1], 0
                nxt += 1
                if lag not in active:
                    while i - got >= lag and w[i - got] == w[i - got - lag]:
                        got += 1
                    if got:
                        active[lag] = got
            i += 1
        return sorted((s, n, q) for (s, n), q in runs.items())


def collapse(w: list[str], runs: list[Run]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return w
    gone = bytearray(len(w))
    for start, length, period in runs:
        gone[start + period:start + length] = b"\1" * (length - period)
    return [x for x, g in zip(w, gone) if not g]


def best(runs: list[Run]) -> Run | None:
    """The run of greatest exact length/period; ties: least start, then period."""
    out = None
    for r in runs:
        if out is None or r[1] * out[2] > out[1] * r[2]:
            out = r
    return out


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, text: str = "text", key: str = "doc_id",
              prepare: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """Per row: key, n_words, runs (start, length, period; by start), the best run's three numbers or nulls, and the collapsed text.

    ``prepare(key, words)`` may give other words than the text's own.
    """
    named = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    finder = Finder(min_length, min_exponent)

    def run(cols: dict) -> dict:
        texts = [words(t) for t in cols["t"]]
        if prepare:
            texts = [prepare(k, w) for k, w in zip(cols["k"], texts)]
        out: dict = {"k": cols["k"], "n_words": [len(w) for w in texts], "runs": [], "start": [], "length": [], "period": [], "collapsed": []}
        for w, runs in zip(texts, finder.of(texts)):
            top = best(runs) or (None, None, None)
            out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs])
            for name, x in zip(("start", "length", "period"), top):
                out[name].append(x)
            out["collapsed"].append(" ".join(collapse(w, runs)))
        return out

    kind = named.schema["k"].dataType.simpleString()
    schema = (f"k {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
              "start long, length long, period long, collapsed string")
    return map_batches(named, run, schema).withColumnRenamed("k", key)


def planted(doc_id: int | None, w: list[str]) -> list[str]:
    """The words that the contract of op11 looks at: a tenth of the documents turn periodic from some word on."""
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def query(spark, sf_dir: str) -> DataFrame:
    runs = find_runs(table(spark, sf_dir, "documents"), prepare=planted)
    said = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    said = F.concat(F.array_join(said, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
