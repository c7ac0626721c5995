"""Extras the reference declares but does not implement (labelled as extras, not parity).

* ``changed_rows``: change detection between two snapshots by key.
* ``changed_values``: the columns that changed, with both values.
* ``completeness``: NULL count per column in one pass.
* ``duplicate_keys``: keys that occur more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_rows(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``(key, change)``, one row per key, with change in inserted / deleted / updated / unchanged.

    A repeated key is unchanged when both snapshots hold the same rows equally often. The
    snapshots are counted by key and value hash, then by key: two map-side combined
    aggregates and no join, so a key with n and m rows costs n + m. NULLs are part
    of the hash (NULL -> value counts as a change), and the NULL key is one key.
    """
    def counted(df: DataFrame, in_old: int) -> DataFrame:
        value = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])
        return df.select(F.col(key), value.alias("_value"), F.lit(in_old).alias("_old"), F.lit(1 - in_old).alias("_new"))

    per_value = (
        counted(old, 1).unionByName(counted(new, 0))
        .groupBy(key, "_value").agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    )
    per_key = per_value.groupBy(key).agg(
        F.sum("_old").alias("_n_old"), F.sum("_new").alias("_n_new"),
        F.max(F.col("_old") != F.col("_new")).alias("_differs"),
    )
    change = (
        F.when(F.col("_n_old") == 0, F.lit("inserted"))
        .when(F.col("_n_new") == 0, F.lit("deleted"))
        .when(F.col("_differs"), F.lit("updated"))
        .otherwise(F.lit("unchanged"))
    )
    return per_key.select(key, change.alias("change"))


def changed_values(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``(key, column_name, old_value, new_value, n_old, n_new)``: the columns in which a key's rows differ, with what they lost and got.

    One multiset difference by key, column and value (as strings; NULL is a value), map-side
    combined and without a join: values that both snapshots hold equally often cancel out.
    ``n_old`` and ``n_new`` count the values that only the old or only the new one holds; of several
    the least is shown. A key that only one snapshot has shows all its columns, with NULL and 0
    on the other side. A key with very many rows is spread over its values.
    """
    def cells(df: DataFrame, sign: int) -> DataFrame:
        structs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
        return df.select(F.col(key), F.inline(F.array(*structs))).withColumn("_sign", F.lit(sign).cast("bigint"))

    left = cells(old, -1).unionByName(cells(new, 1)).groupBy(key, "column_name", "value").agg(F.sum("_sign").alias("_n")).where("_n != 0")
    lost, got = F.col("_n") < 0, F.col("_n") > 0
    return left.groupBy(key, "column_name").agg(
        F.min(F.when(lost, F.col("value"))).alias("old_value"), F.min(F.when(got, F.col("value"))).alias("new_value"),
        F.coalesce(F.sum(F.when(lost, -F.col("_n"))), F.lit(0)).cast("bigint").alias("n_old"),
        F.coalesce(F.sum(F.when(got, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_new"))


def completeness(df: DataFrame) -> DataFrame:
    """``(column_name, null_count, total_count)`` for every column, from one aggregate."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ])
    return agg.select(F.inline(pairs), F.col("_total").alias("total_count"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, copies)`` for keys present more than once (hash aggregate, map-side combined)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
