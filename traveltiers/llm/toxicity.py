"""Operator 6: toxicity by FTRL-proximal logistic regression.

Features: the presence of word unigrams, bigrams and skip-grams (one word left out), words
lower-cased and split at ASCII punctuation, hashed to 2**20 coordinates. The model learns
from at most SAMPLE_ROWS labelled documents, the first by the hash of their id among those
whose crc32(id as text) mod 3 is not 1; it scores every whole text.

Nulls and empty texts have no features and get the bias's score. A null id counts as held
out. A document with several labels is toxic if one says so; null labels teach nothing. With
no labelled rows the score is 0.5. Rows repeat as in the input; an empty table gives an empty
result; columns other than id and text never reach the features.
"""

from __future__ import annotations

import string
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm import ftrl
from traveltiers.llm.common import map_batches, table

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
_SPLIT = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_NO_VALUE = np.zeros(0)


def hashed(text: str | None) -> np.ndarray:
    """The distinct coordinates of a text's words, bigrams and skip-grams."""
    toks = text.lower().encode().translate(_SPLIT).split() if text else []
    if not toks:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, toks), np.uint64, len(toks))
    mix = np.uint64(0x9E3779B97F4A7C15)
    grams = [h * mix, (h[:-1] * np.uint64(0x100000001B3) + h[1:]) * mix, (h[:-2] * np.uint64(0x1000000016F) + h[2:] + np.uint64(1)) * mix]
    return np.unique(np.concatenate(grams) >> np.uint64(64 - ftrl.BITS)).astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    at = hashed(text)
    return at, np.ones(len(at))


def held_out(key) -> F.Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> dict[int, float]:
    """Weights learned from the labelled documents that are not held out, at most ``rows`` of them."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("y")).dropna().filter(~held_out(F.col("id")))
    chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return ftrl.fit(texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), features)  # broadcast: at most `rows` rows


def score(docs: DataFrame, weights: dict[int, float], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    named = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    kind = named.schema["k"].dataType.simpleString()
    out = map_batches(named, lambda cols, own: {"k": cols["k"], "score": [own.score(t) for t in cols["t"]]},
                      f"k {kind}, score double", lambda: ftrl.Scorer(model.value, features))
    return out.select(F.col("k").alias(key), held_out(F.col("k")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
