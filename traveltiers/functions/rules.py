"""Column builders for the cleaning, segmentation and rate rules.

Every function takes column names or ``Column`` objects and returns a
``Column`` built only from Spark built-ins, so it stays inside whole-stage
codegen and can be reused in any ``select``/``agg``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Thresholds, labels and formats that define the results.
# ---------------------------------------------------------------------------
PRICE_MIN = 0
PRICE_MAX = 50000
LATITUDE_BOUND = 90
LONGITUDE_BOUND = 180
PRICE_SCALE = 2
COORDINATE_SCALE = 6
FREQUENCY_BANDS = [(10, "high_frequency"), (3, "medium_frequency")]
FREQUENCY_DEFAULT = "low_frequency"
PRICE_BANDS = [(500, "premium"), (200, "standard")]
PRICE_DEFAULT = "budget"
TIER_BANDS = [(5000, "platinum"), (2000, "gold"), (500, "silver")]
TIER_DEFAULT = "bronze"
WEEKEND_DAYS = (1, 7)  # DAYOFWEEK: 1 = Sunday ... 7 = Saturday
WEEKEND = "weekend"
WEEKDAY = "weekday"
NORTHERN = "Northern"
SOUTHERN = "Southern"
ROW_HASH_SEPARATOR = "|"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Generic helpers
# ---------------------------------------------------------------------------
def band(value: str | Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """``CASE WHEN v >= t1 THEN l1 WHEN v >= t2 THEN l2 ... ELSE default``.

    Bands are tested in the given order; NULL (and anything below the last
    threshold) falls to ``default``.
    """
    v = col(value)
    expr = None
    for threshold, label in bands:
        cond = v >= F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def floor_div(a: str | Column, b: str | Column) -> Column:
    """Exact ``floor(a / b)`` for non-negative integers, as decimal(38,0).

    ``a - pmod(a, b)`` is a multiple of ``b``, so the decimal quotient is an
    integer and no intermediate rounding can move it.
    """
    a = col(a).cast("decimal(38,0)")
    b = col(b).cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def pct(num: str | Column, den: str | Column) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), 2)`` for counts, as double.

    Rounded half-up from exact integers: ``floor((20000*num + den) / (2*den)) / 100``.
    NULL when ``den`` is 0 or NULL.
    """
    n = col(num).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    q = floor_div(n * F.lit(20000) + d, d * F.lit(2))
    return F.when(d != 0, q.cast("double") / F.lit(100.0))


def cents(value: str | Column) -> Column:
    """A cleaned two-decimal price as exact integer cents (``bigint``).

    Money is summed as cents: a ``bigint`` sum stays in whole-stage codegen
    (a decimal sum of precision > 18 falls back to ``BigDecimal`` per row) and
    is exact. Cleaned prices are at most 50,000, so a group overflows only
    beyond ~1.8e12 rows, and with ANSI mode (the Spark 4 default, pinned by
    ``get_session``) an overflow raises instead of wrapping.
    """
    return F.rint(col(value) * F.lit(100)).cast("bigint")


def money_from_cents(total: str | Column) -> Column:
    """Exact cents back to dollars as double (correctly rounded)."""
    return col(total).cast("double") / F.lit(100.0)


def avg_cents(total: str | Column, n: str | Column) -> Column:
    """``ROUND(AVG(price), 2)`` from a cents total and a count, half-up.

    ``floor((2*cents + n) / (2*n)) / 100``; NULL when ``n`` is 0.
    """
    c = col(total).cast("decimal(38,0)")
    cnt = col(n).cast("decimal(38,0)")
    q = floor_div(c * F.lit(2) + cnt, cnt * F.lit(2))
    return F.when(cnt > 0, q.cast("double") / F.lit(100.0))


def audit_ts(run_ts: str | None = None) -> Column:
    """Run timestamp for audit columns; ``current_timestamp()`` when not pinned."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


def row_hash(*cols: str | Column, sep: str = ROW_HASH_SEPARATOR) -> Column:
    """``md5(concat_ws(sep, ...))`` over the given columns (NULLs skipped)."""
    return F.md5(F.concat_ws(sep, *[col(c).cast("string") for c in cols]))


# ---------------------------------------------------------------------------
# Purchase rules
# ---------------------------------------------------------------------------
def clean_price(price: str | Column = "price", lo: float = PRICE_MIN, hi: float = PRICE_MAX) -> Column:
    """NULL when NULL, below ``lo`` or above ``hi`` (bounds valid), else rounded to cents.

    NaN compares above every number in Spark, so it is treated as too large.
    """
    p = col(price)
    return (
        F.when(p.isNull() | (p < F.lit(lo)), F.lit(None).cast("double"))
        .when(p > F.lit(hi), F.lit(None).cast("double"))
        .otherwise(F.round(p, PRICE_SCALE))
    )


def price_invalid(price: str | Column = "price", lo: float = PRICE_MIN, hi: float = PRICE_MAX) -> Column:
    p = col(price)
    return F.when(p.isNull() | (p < F.lit(lo)) | (p > F.lit(hi)), F.lit(True)).otherwise(F.lit(False))


def location_invalid(
    lat: str | Column = "user_latitude",
    lon: str | Column = "user_longitude",
    lat_bound: float = LATITUDE_BOUND,
    lon_bound: float = LONGITUDE_BOUND,
) -> Column:
    """True when a coordinate is NULL or outside its range; the bounds are valid."""
    la, lo = col(lat), col(lon)
    return (
        F.when(la.isNull() | lo.isNull(), F.lit(True))
        .when((la < F.lit(-lat_bound)) | (la > F.lit(lat_bound)), F.lit(True))
        .when((lo < F.lit(-lon_bound)) | (lo > F.lit(lon_bound)), F.lit(True))
        .otherwise(F.lit(False))
    )


def clean_coordinate(value: str | Column, bound: float, scale: int = COORDINATE_SCALE) -> Column:
    """NULL when NULL or outside ``[-bound, bound]``, else rounded to ``scale`` places."""
    v = col(value)
    return F.when(
        v.isNull() | (v < F.lit(-bound)) | (v > F.lit(bound)), F.lit(None).cast("double")
    ).otherwise(F.round(v, scale))


def clean_latitude(value: str | Column) -> Column:
    return clean_coordinate(value, LATITUDE_BOUND)


def clean_longitude(value: str | Column) -> Column:
    return clean_coordinate(value, LONGITUDE_BOUND)


def day_type(ts: str | Column) -> Column:
    """``weekend`` for Sunday/Saturday, else ``weekday`` (NULL timestamp -> weekday)."""
    return F.when(F.dayofweek(col(ts)).isin(*WEEKEND_DAYS), F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def hemisphere(lat: str | Column) -> Column:
    """``Northern`` when latitude >= 0, else ``Southern`` (NULL -> Southern)."""
    return F.when(col(lat) >= F.lit(0), F.lit(NORTHERN)).otherwise(F.lit(SOUTHERN))


def frequency_segment(purchases: str | Column) -> Column:
    return band(purchases, FREQUENCY_BANDS, FREQUENCY_DEFAULT)


def price_segment(mean_price: str | Column) -> Column:
    return band(mean_price, PRICE_BANDS, PRICE_DEFAULT)


def customer_tier(spend: str | Column) -> Column:
    return band(spend, TIER_BANDS, TIER_DEFAULT)


def normalize_name(name: str | Column) -> Column:
    """``TRIM(INITCAP(name))``: words split on spaces only, inner spaces kept."""
    return F.trim(F.initcap(col(name)))


def default_false(flag: str | Column) -> Column:
    return F.coalesce(col(flag), F.lit(False))
