"""Operator 4: token counts by a sentencepiece model, from pre-token frequencies.

A pre-token is a run of spaces with what follows it up to the next space or line feed, or a
single line feed. No piece of the model reaches across such a border (checked when the model
is loaded), so a text's token count is the sum of its pre-tokens' counts. Per block of
documents: the frequency table (document, pre-token) is built, pieces are counted once for
each distinct pre-token, the counts are joined to the frequencies and summed by document.
Ids are never kept. Distinct pre-tokens already counted by a worker are remembered up to
MEMO, so memory is bounded whatever the corpus holds.

The distinct table is kept by block, not in one shuffle over the corpus: that would move
every (document, pre-token) pair (86 million on 0.5 GB of input).

Null or empty text: 0 bytes, 0 tokens. Rows repeat as in the input; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import map_batches, remember, table

LIMIT = 4096
MEMO = 400_000
SPACE = "▁"
_PRE = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


class PieceCounter:
    """Counts pieces by pre-token, with a bounded memory of counts."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [p for i in range(self.sp.get_piece_size()) if len(p := self.sp.id_to_piece(i)) > 1
                  and not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i))]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("a piece of this model reaches across a pre-token border")
        self.memo: dict[str, int] = {}

    def pieces(self, pre: list[str]) -> list[int]:
        """Piece counts of pre-tokens. The library puts one space before a text; a line feed in front stands in for it."""
        texts = [p[1:] if p[0] == SPACE else "\n" + p for p in pre]
        return [len(ids) - (p[0] != SPACE) * 2 if p != SPACE else 1 for p, ids in zip(pre, self.sp.encode(texts, num_threads=1))]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, by a join of the block's frequency table with its distinct pre-tokens."""
        split = [_PRE.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        code: dict[str, int] = {}
        flat = np.fromiter((code.setdefault(p, len(code)) for p in chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if len(self.memo) + len(code) > MEMO:
            self.memo.clear()
        memo = self.memo
        new = [p for p in code if p not in memo]
        memo.update(zip(new, self.pieces(new)))
        per_code = np.fromiter(map(memo.__getitem__, code), np.int64, len(code))
        doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        pair, times = np.unique(doc * max(1, len(code)) + flat, return_counts=True)  # (document, pre-token) and its frequency
        return np.bincount(pair // max(1, len(code)), weights=times * per_code[pair % max(1, len(code))], minlength=len(texts)).astype(np.int64)


_counters: dict[int, PieceCounter] = {}
remember(__name__, _counters)


def counter(model: bytes) -> PieceCounter:
    """One counter a worker process and model, kept between tasks."""
    key = hash(model)
    if key not in _counters:
        _counters.clear()
        _counters[key] = PieceCounter(model)
    return _counters[key]


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit. The model's file is read by the driver and broadcast (its size is the vocabulary's)."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    named = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(cols: dict, own: PieceCounter) -> dict:
        return {"k": cols["k"], "n_bytes": [len(t.encode()) if t else 0 for t in cols["t"]], "n_tokens": own.count(cols["t"])}

    kind = named.schema["k"].dataType.simpleString()
    out = map_batches(named, run, f"k {kind}, n_bytes long, n_tokens long", lambda: counter(model.value))
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
