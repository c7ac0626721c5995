"""Exact, mergeable sets of ids: one 64-bit word per 64 neighbouring ids.

An id is a ``bigint``; ``word_of`` is its upper 58 bits and ``bit_of`` its place in the
word. A set is the rows ``(word, bits)``. Words are OR-ed, so sets of parts (days,
tasks, files) merge into sets of wholes without going back to the ids, and a set's size is
the sum of ``bit_count``. Neighbouring ids share a row (up to 64 of them); a lone id costs one
row, as it would in a list. Every step is a hash aggregate on (keys, word) with map-side
combine: a hot key spreads over its words, and no buffer holds a whole set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 6


def word_of(key: str | Column) -> Column:
    """The id's word; NULL for NULL. The shift keeps the sign, so negative ids have words of their own."""
    return F.shiftright(F.col(key) if isinstance(key, str) else key, WORD_BITS)


def bit_of(key: str | Column) -> Column:
    """The word with only this id's bit set; NULL for NULL."""
    place = (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def size(bits: str | Column = "bits") -> Column:
    """Aggregate: how many ids the words of a group hold (each word once)."""
    return F.coalesce(F.sum(F.bit_count(bits).cast("bigint")), F.lit(0).cast("bigint"))


def words(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``(kind, word, bits)``: the distinct ids of several columns in one pass over ``df``; NULLs left out.

    ``kinds`` maps a name to its column.
    """
    structs = [F.struct(F.lit(k).alias("kind"), word_of(c).alias("word"), bit_of(c).alias("bit")) for k, c in kinds.items()]
    rows = df.select(F.inline(F.array(*structs))) if len(structs) > 1 else df.select(F.inline(F.array(structs[0])))
    return rows.where(F.col("word").isNotNull()).groupBy("kind", "word").agg(F.bit_or("bit").alias("bits"))


def union_of(sets: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sets)


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """The ids of ``left`` that ``right`` lacks, by kind: one aggregate over both, no join."""
    tagged = union_of([left.select("kind", "word", F.col("bits").alias("own"), F.lit(0).cast("bigint").alias("others")),
                       right.select("kind", "word", F.lit(0).cast("bigint").alias("own"), F.col("bits").alias("others"))])
    both = tagged.groupBy("kind", "word").agg(F.bit_or("own").alias("own"), F.bit_or("others").alias("others"))
    rest = F.col("own").bitwiseAND(F.bitwise_not("others"))
    return both.select("kind", "word", rest.alias("bits")).where(F.col("bits") != 0)


def ids(sets: DataFrame) -> DataFrame:
    """``(kind, id)``: the words unpacked, a row per id."""
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)), lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1)) == 1)
    return sets.select("kind", "word", F.explode(places).alias("place")).select(
        "kind", (F.shiftleft("word", WORD_BITS) + F.col("place")).alias("id"))
