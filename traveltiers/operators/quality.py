"""Data-quality checks as DataFrames.

Each check is a one-row aggregate with the common schema
``(actual, check, expected, layer, status, table)`` (all strings). The checks
are joined with ``unionByName`` into one plan, so a whole quality run is one
query (AQE runs its stages as a few small jobs); only its 17 result rows ever
reach the driver (at the gate).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traveltiers.operators import idsets
from traveltiers.sources.tables import resolve

# ---------------------------------------------------------------------------
# Audit-log columns, statuses, check names, expectations, formats,
# and the tables and columns that are validated.
# ---------------------------------------------------------------------------
CHECK_COLUMNS = ["actual", "check", "expected", "layer", "status", "table"]
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
RECORD_COUNT = "record_count"
REFERENTIAL_INTEGRITY = "referential_integrity"
DATA_FRESHNESS = "data_freshness"
BUSINESS_RULE = "business_rule"
EXPECT_ROWS = "> 0"
EXPECT_NO_ORPHANS = "0 orphans"
EXPECT_FRESH = "< 24 hours"
EXPECT_NO_NEGATIVE_PRICES = "0 negative prices"
EXPECT_VALID_RATES = "0 invalid rates"
FRESHNESS_LIMIT_HOURS = 24.0
AGE_UNKNOWN = "inf hours"
RATE_MIN, RATE_MAX = 0, 100
LAYER_TABLES = [
    ("bronze_travel_purchases", "bronze"),
    ("bronze_user_features", "bronze"),
    ("bronze_destinations", "bronze"),
    ("silver_travel_purchases", "silver"),
    ("silver_users", "silver"),
    ("silver_destinations", "silver"),
    ("gold_daily_revenue_metrics", "gold"),
    ("gold_destination_performance", "gold"),
    ("gold_user_engagement", "gold"),
    ("gold_monthly_summary", "gold"),
]
FRESHNESS_COLUMNS = [
    ("bronze_travel_purchases", "_ingested_at"),
    ("silver_travel_purchases", "_processed_at"),
    ("gold_daily_revenue_metrics", "_generated_at"),
]
REFERENCES = [
    ("user_id", "silver_users", "silver_travel_purchases -> silver_users"),
    ("destination_id", "silver_destinations", "silver_travel_purchases -> silver_destinations"),
]
CHECK_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CHECK_COLUMNS])


@dataclass(frozen=True)
class TablePart:
    """A table and what is checked on it: the time column of its freshness, and ``(expected, violation)`` rules."""

    df: DataFrame
    name: str
    layer: str
    ts_col: str | None = None
    rules: Sequence[tuple[str, Column]] = ()


class DataQualityError(Exception):
    """Raised by the gate after the audit log is written, when a check FAILs."""


def _check_row(agg: DataFrame, check: str, table: str | Column, layer: str | Column,
               expected: str, actual: Column, status: Column) -> DataFrame:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return agg.select(
        actual.cast("string").alias("actual"),
        F.lit(check).alias("check"),
        F.lit(expected).alias("expected"),
        lit(layer).alias("layer"),
        status.alias("status"),
        lit(table).alias("table"),
    )


def _literal_row(spark: SparkSession, **values: str) -> DataFrame:
    return spark.createDataFrame([tuple(values.get(c) for c in CHECK_COLUMNS)], CHECK_SCHEMA)


def record_count_check(spark: SparkSession, table: str | DataFrame, name: str, layer: str) -> DataFrame:
    """PASS when the table has rows, else FAIL; a table that cannot be read is FAIL with the error."""
    try:
        df = resolve(spark, table)
    except Exception as e:  # the table itself is missing or unreadable
        return _literal_row(spark, check=RECORD_COUNT, table=name, layer=layer,
                            expected=EXPECT_ROWS, actual=str(e), status=FAIL)
    n = F.col("_n")
    agg = df.agg(F.count(F.lit(1)).alias("_n"))
    return _check_row(agg, RECORD_COUNT, name, layer, EXPECT_ROWS, n,
                      F.when(n > 0, F.lit(PASS)).otherwise(F.lit(FAIL)))


def key_sets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct non-NULL values of several ``bigint`` key columns as id sets, in one pass (``operators.idsets``)."""
    return idsets.words(df, {k: k for k in keys})


def orphan_sets(fact_sets: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Ids of the fact's key sets absent from their dimension, as id sets: ``dims`` maps a key to its dimension.

    The fact's keys were reduced to words before any shuffle (a hot key costs one row a task), and
    one aggregate over the words of both sides takes the place of an anti join a key.
    """
    return idsets.minus(fact_sets, idsets.union_of([key_sets(dim, [key]) for key, dim in dims.items()]))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL ``key`` values of ``fact`` absent from ``dim``."""
    return idsets.ids(orphan_sets(key_sets(fact, [key]), {key: dim})).select(F.col("id").alias(key))


def fact_key_sets(partials: DataFrame) -> DataFrame:
    """The fact's user and destination ids from its stored partials (``gold.purchase_partials``): no pass over the fact."""
    kinds = F.concat("kind", F.lit("_id"))
    return partials.where(F.col("word").isNotNull()).groupBy(kinds.alias("kind"), "word").agg(F.bit_or("bits").alias("bits"))


def _orphan_rows(orphans: DataFrame, references: Sequence[tuple[str, str, str]], layer: str) -> DataFrame:
    """One check row per ``(key, dimension, label)``, also where there are no orphans."""
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == key, F.bit_count("bits"))), F.lit(0)).cast("bigint").alias(f"_n{i}")
              for i, (key, _, _) in enumerate(references)]
    rows = []
    for i, (_, _, label) in enumerate(references):
        n = F.col(f"_n{i}")
        rows.append(_row(REFERENTIAL_INTEGRITY, label, layer, EXPECT_NO_ORPHANS, n, F.when(n == 0, F.lit(PASS)).otherwise(F.lit(WARN))))
    return orphans.agg(*counts).select(F.inline(F.array(*rows)))


def referential_integrity_check(fact: DataFrame, dim: DataFrame, key: str, label: str,
                                layer: str = "silver") -> DataFrame:
    """PASS with 0 orphan keys, else WARN (never FAIL)."""
    return _orphan_rows(orphan_sets(key_sets(fact, [key]), {key: dim}), [(key, "", label)], layer)


def _one_decimal(age: Column) -> Column:
    """``x.y hours`` as C's %.1f gives it: the double's exact binary value, ties to the even digit."""
    size = F.abs(age)
    whole = F.floor(size)
    tenths = ((size - whole) * F.lit(float(1 << 58))).cast("bigint") * 10  # the fraction in units of 2**-58, exact
    digit, left = F.shiftright(tenths, 58), tenths.bitwiseAND(F.lit((1 << 58) - 1))
    half = F.lit(1 << 57)
    up = (left > half) | ((left == half) & (digit % 2 == 1))
    n = whole * 10 + digit + up.cast("bigint")
    return F.concat(F.when(age < 0, "-").otherwise(""), F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string"), F.lit(" hours"))


def _age(max_ts: Column, as_of: str | None, limit_hours: float) -> tuple[Column, Column]:
    """``(actual, status)`` of a freshness check from the column holding ``max(ts)``."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    age = (F.unix_micros(now) - F.unix_micros(max_ts)) / F.lit(3.6e9)
    actual = F.when(max_ts.isNull(), F.lit(AGE_UNKNOWN)).otherwise(_one_decimal(age))
    status = F.when(age < F.lit(limit_hours), F.lit(PASS)).otherwise(F.lit(WARN))
    return actual, status


def freshness_check(df: DataFrame, name: str, ts_col: str, as_of: str | None = None,
                    limit_hours: float = FRESHNESS_LIMIT_HOURS) -> DataFrame:
    """Age of ``max(ts_col)`` against ``as_of`` (default: now), computed in Spark.

    PASS when strictly under the limit, else WARN; an empty table is ``inf hours``.
    """
    agg = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("_max"))
    actual, status = _age(F.col("_max"), as_of, limit_hours)
    layer = F.substring_index(F.lit(name), "_", 1)
    expected = EXPECT_FRESH if limit_hours == FRESHNESS_LIMIT_HOURS else f"< {limit_hours:g} hours"
    return _check_row(agg, DATA_FRESHNESS, name, layer, expected, actual, status)


def business_rule_check(df: DataFrame, name: str, layer: str, expected: str, violation: Column) -> DataFrame:
    """PASS when no row violates the rule, else FAIL."""
    agg = df.agg(F.count_if(violation).alias("_n"))
    n = F.col("_n")
    return _check_row(agg, BUSINESS_RULE, name, layer, expected, n,
                      F.when(n == 0, F.lit(PASS)).otherwise(F.lit(FAIL)))


def union_checks(checks: Iterable[DataFrame]) -> DataFrame:
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    return out


def record_count_checks(spark: SparkSession, tables: dict[str, str | DataFrame],
                        layer_tables: Sequence[tuple[str, str]] = LAYER_TABLES) -> DataFrame:
    return union_checks(
        record_count_check(spark, tables.get(name, name), name, layer) for name, layer in layer_tables
    )


def referential_integrity_checks(tables: Mapping[str, DataFrame], partials: DataFrame | None = None) -> DataFrame:
    """Every reference of the fact from one pass over it, or from its ``partials`` without one."""
    sets = key_sets(tables["silver_travel_purchases"], [k for k, _, _ in REFERENCES]) if partials is None else fact_key_sets(partials)
    return _orphan_rows(orphan_sets(sets, {key: tables[dim] for key, dim, _ in REFERENCES}), REFERENCES, "silver")


def freshness_checks(spark: SparkSession, tables: dict[str, str | DataFrame], as_of: str | None = None,
                     columns: Sequence[tuple[str, str]] = FRESHNESS_COLUMNS) -> DataFrame:
    rows = []
    for name, ts_col in columns:
        try:
            df = resolve(spark, tables.get(name, name))
            rows.append(freshness_check(df, name, ts_col, as_of))
        except Exception as e:  # deliberate: a missing table is a FAIL row, not silently skipped
            rows.append(_literal_row(spark, check=DATA_FRESHNESS, table=name,
                                     layer=name.split("_")[0], expected=EXPECT_FRESH,
                                     actual=str(e), status=FAIL))
    return union_checks(rows)


def business_rules() -> list[tuple[str, str, str, Column]]:
    """``(table, layer, expected, violation)`` for every business rule."""
    rate = F.col("conversion_rate_pct")
    return [
        ("silver_travel_purchases", "silver", EXPECT_NO_NEGATIVE_PRICES, F.col("price_usd") < 0),
        ("gold_daily_revenue_metrics", "gold", EXPECT_VALID_RATES, (rate < RATE_MIN) | (rate > RATE_MAX)),
    ]


def business_rule_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return union_checks(
        business_rule_check(tables[t], t, layer, expected, violation)
        for t, layer, expected, violation in business_rules()
    )


def _row(check: str, table: str, layer: str | Column, expected: str, actual: Column, status: Column) -> Column:
    return F.struct(
        actual.cast("string").alias("actual"),
        F.lit(check).alias("check"),
        F.lit(expected).alias("expected"),
        (layer if isinstance(layer, Column) else F.lit(layer)).alias("layer"),
        status.alias("status"),
        F.lit(table).alias("table"),
    )


def table_checks(spark: SparkSession, parts: Sequence[TablePart], as_of: str | None = None) -> DataFrame:
    """All checks of several tables from one grouped aggregate over their tagged rows.

    A row of a table brings its tag, its time and whether it violates each rule; one aggregate by
    tag (map-side combined, so a task passes on one row a table) gives count, latest time and
    violations, and a second one over these few rows lays them out, also for tables without rows.
    """
    depth = max((len(p.rules) for p in parts), default=0)
    tagged = []
    for tag, p in enumerate(parts):
        when = F.col(p.ts_col).cast("timestamp") if p.ts_col else F.lit(None).cast("timestamp")
        broken = [F.coalesce(v, F.lit(False)) for _, v in p.rules] + [F.lit(False)] * (depth - len(p.rules))
        tagged.append(p.df.select(F.lit(tag).alias("_tag"), when.alias("_ts"), *[v.alias(f"_bad{i}") for i, v in enumerate(broken)]))
    by_tag = idsets.union_of(tagged).groupBy("_tag").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_ts").alias("_max"), *[F.count_if(f"_bad{i}").alias(f"_bad{i}") for i in range(depth)])
    of = lambda tag, c: F.max(F.when(F.col("_tag") == tag, F.col(c)))
    flat, rows = [], []
    for tag, p in enumerate(parts):
        n = F.col(f"_n{tag}")
        flat.append(F.coalesce(of(tag, "_n"), F.lit(0).cast("bigint")).alias(f"_n{tag}"))
        rows.append(_row(RECORD_COUNT, p.name, p.layer, EXPECT_ROWS, n, F.when(n > 0, F.lit(PASS)).otherwise(F.lit(FAIL))))
        if p.ts_col:
            flat.append(of(tag, "_max").alias(f"_max{tag}"))
            actual, status = _age(F.col(f"_max{tag}"), as_of, FRESHNESS_LIMIT_HOURS)
            rows.append(_row(DATA_FRESHNESS, p.name, F.substring_index(F.lit(p.name), "_", 1), EXPECT_FRESH, actual, status))
        for i, (expected, _) in enumerate(p.rules):
            bad = F.col(f"_bad{tag}_{i}")
            flat.append(F.coalesce(of(tag, f"_bad{i}"), F.lit(0).cast("bigint")).alias(f"_bad{tag}_{i}"))
            rows.append(_row(BUSINESS_RULE, p.name, p.layer, expected, bad, F.when(bad == 0, F.lit(PASS)).otherwise(F.lit(FAIL))))
    return by_tag.agg(*flat).select(F.inline(F.array(*rows)))


def _check_names(name: str, layer: str) -> list[dict[str, str]]:
    """The checks that a table has, for FAIL rows when it is missing."""
    checks = [(RECORD_COUNT, EXPECT_ROWS)]
    if name in dict(FRESHNESS_COLUMNS):
        checks.append((DATA_FRESHNESS, EXPECT_FRESH))
    checks += [(BUSINESS_RULE, expected) for t, _, expected, _ in business_rules() if t == name]
    return [{"check": c, "table": name, "layer": layer, "expected": e} for c, e in checks]


def _reference_name(label: str) -> dict[str, str]:
    return {"check": REFERENTIAL_INTEGRITY, "table": label, "layer": "silver", "expected": EXPECT_NO_ORPHANS}


def _table_part(spark: SparkSession, tables: Mapping[str, str | DataFrame], name: str, layer: str) -> TablePart:
    rules = [(expected, violation) for t, _, expected, violation in business_rules() if t == name]
    part = TablePart(resolve(spark, tables.get(name, name)), name, layer, dict(FRESHNESS_COLUMNS).get(name), rules)
    # Resolved here: a table without a column that its checks need counts as missing.
    part.df.select(*([part.ts_col] if part.ts_col else []), *[violation for _, violation in rules])
    return part


def quality_checks(spark: SparkSession, tables: Mapping[str, str | DataFrame], as_of: str | None = None,
                   partials: DataFrame | None = None) -> DataFrame:
    """The 17-row audit log: 10 record counts, 2 orphan checks, 3 freshness, 2 rules.

    Counts, freshness and rules of all tables come from one grouped aggregate (``table_checks``),
    both orphan checks from one pass over the fact, or none when its ``partials``
    (``gold.purchase_partials``) are given. Checks on a table that is missing are FAIL rows with
    the error.
    """
    parts, out = [], []
    for name, layer in LAYER_TABLES:
        try:
            parts.append(_table_part(spark, tables, name, layer))
        except Exception as e:  # a missing table: FAIL rows instead of a crashed run
            out += [_literal_row(spark, **c, actual=str(e), status=FAIL) for c in _check_names(name, layer)]
    if parts:
        out.append(table_checks(spark, parts, as_of))
    dims, references = {}, []
    for key, dim, label in REFERENCES:
        try:
            fact = resolve(spark, tables.get("silver_travel_purchases", "silver_travel_purchases")).select(key)
            dims[key] = resolve(spark, tables.get(dim, dim)).select(key)
            references.append((key, dim, label))
        except Exception as e:
            out.append(_literal_row(spark, **_reference_name(label), actual=str(e), status=FAIL))
    if references:
        fact = resolve(spark, tables.get("silver_travel_purchases", "silver_travel_purchases"))
        sets = key_sets(fact, list(dims)) if partials is None else fact_key_sets(partials)
        out.append(_orphan_rows(orphan_sets(sets, dims), references, "silver"))
    return union_checks(out)


def audit_rows(spark: SparkSession, tables: Mapping[str, str | DataFrame], as_of: str | None = None,
               partials: DataFrame | None = None) -> list[Row]:
    """The rows of ``quality_checks``, also when a table resolves but can't be read.

    All checks run as one query; if that fails, each table's run by themselves, and
    those that fail become FAIL rows with the error.
    """
    try:
        return quality_checks(spark, tables, as_of, partials).collect()  # 17 rows
    except Exception:  # deliberate: some table can't be read; the others are still checked below
        def one(name: str, layer: str) -> DataFrame:
            return table_checks(spark, [_table_part(spark, tables, name, layer)], as_of)

        def reference(key: str, dim: str, label: str) -> DataFrame:
            get = lambda t: resolve(spark, tables.get(t, t))
            return referential_integrity_check(get("silver_travel_purchases"), get(dim), key, label)

        alone = [(partial(one, name, layer), _check_names(name, layer)) for name, layer in LAYER_TABLES]
        alone += [(partial(reference, *r), [_reference_name(r[2])]) for r in REFERENCES]
        rows: list[Row] = []
        for make, checks in alone:
            try:
                rows += make().collect()
            except Exception as e:
                failed = ({**c, "actual": str(e), "status": FAIL} for c in checks)
                rows += [Row(**{name: c[name] for name in CHECK_COLUMNS}) for c in failed]
        return rows


def summarize(audit: DataFrame) -> DataFrame:
    """One row: PASS / WARN / FAIL / total counts and the verdict (FAIL iff any FAIL)."""
    s = F.col("status")
    agg = audit.agg(
        F.count_if(s == PASS).alias("pass_count"),
        F.count_if(s == WARN).alias("warn_count"),
        F.count_if(s == FAIL).alias("fail_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return agg.withColumn(
        "overall_status", F.when(F.col("fail_count") == 0, F.lit(PASS)).otherwise(F.lit(FAIL))
    )


def gate(audit_rows: Sequence) -> None:
    """Raise when any collected check row FAILed (WARN does not fail the run)."""
    failures = [r for r in audit_rows if r["status"] == FAIL]
    if failures:
        raise DataQualityError(f"Data quality checks failed: {len(failures)} failures detected")
