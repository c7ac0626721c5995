"""Independent DuckDB SQL for every registered query.

The layer tables are derived from the contract of SURVEY section 2, not from another engine's
statement: validity is one predicate a rule, segments and tiers are AS OF lookups in band tables,
every gold table joins one tally of the fact by its key (``tally``) with one set of distinct
pairs a counted id (``spread``), ranks come from a running count over the distinct values, and the
previous month is the row before by number. The plain join-then-group form is in
``tests/naive.py``. Output types are pinned the same way on both sides: integers BIGINT, money and
rates DOUBLE (money summed as DECIMAL(18,2), rounding half-up from integers),
and calendar dates as midnight TIMESTAMPs (a DATE reaches Python as ``date``
from one engine and as a pandas ``Timestamp`` from the other; a timestamp
converts the same way through every path).
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "TIMESTAMP '2024-02-01 12:00:00'"


def _lat(n: str, mult: int, mod: int, off: int) -> str:
    return f"(CAST(({n} * {mult}) % {mod} - {off} AS DOUBLE) + CAST(0.1234567 AS DOUBLE))"


def _lon(n: str, mult: int, mod: int, off: int) -> str:
    return f"(CAST(({n} * {mult}) % {mod} - {off} AS DOUBLE) + CAST(0.7654321 AS DOUBLE))"


def pct(num: str, den: str) -> str:
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST((20000 * CAST({num} AS HUGEINT) + ({den})) // (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / 100.0 END)")


def avg_money(total: str, n: str) -> str:
    return (f"(CASE WHEN ({n}) = 0 THEN NULL ELSE "
            f"CAST((2 * CAST(({total}) * 100 AS HUGEINT) + ({n})) // (2 * CAST({n} AS HUGEINT)) AS DOUBLE) / 100.0 END)")


def initcap(s: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({s}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


SRC_PURCHASE_A = f"""
SELECT event_id AS id, ts,
  CASE WHEN event_id % 1009 = 0 THEN NULL ELSE user_id + CASE WHEN user_id % 29 = 0 THEN 1000000000 ELSE 0 END END AS user_id,
  NULLIF(CAST(json_extract_string(props, '$.k') AS BIGINT), 99) AS destination_id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type IN ('click', 'purchase') END AS clicked,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type = 'purchase' END AS purchased,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS booking_date,
  CASE WHEN event_id % 501 = 0 THEN NULL WHEN event_id % 251 = 0 THEN -value
       WHEN event_id % 997 = 0 THEN CAST(60000.0 AS DOUBLE) ELSE value * 4 END AS price,
  CASE WHEN event_id % 307 = 0 THEN NULL ELSE {_lat('user_id', 37, 181, 90)} END AS user_latitude,
  {_lon('user_id', 53, 361, 180)} AS user_longitude
FROM events"""

SRC_PURCHASE_B = f"""
SELECT l_orderkey * 8 + l_linenumber AS id, l_shipdate AS ts, o_custkey + CASE WHEN o_custkey % 29 = 0 THEN 1000000000 ELSE 0 END AS user_id,
  l_suppkey AS destination_id, l_linestatus = 'F' AS clicked, l_returnflag = 'R' AS purchased,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS booking_date, l_extendedprice AS price,
  {_lat('o_custkey', 37, 181, 90)} AS user_latitude, {_lon('o_custkey', 53, 361, 180)} AS user_longitude
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SRC_USERS = f"""
SELECT c_custkey AS user_id, TIMESTAMP '2024-01-01 00:00:00' AS ts,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal % 1000 END AS mean_price_7d,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey % 15 END AS last_6m_purchases,
  {_lon('c_custkey', 53, 361, 180)} AS user_longitude, {_lat('c_custkey', 37, 181, 90)} AS user_latitude
FROM customer
UNION ALL
SELECT c_custkey, TIMESTAMP '2024-01-15 00:00:00',
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal % 1000 END,
  CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 20 = 0 THEN (c_custkey + 5) % 15 ELSE c_custkey % 15 END,
  {_lon('c_custkey', 53, 361, 180)}, {_lat('c_custkey', 37, 181, 90)}
FROM customer WHERE c_custkey % 10 = 0"""

SRC_DESTINATIONS = f"""
SELECT s_suppkey AS destination_id, lower(concat(' ', s_name, ' city ')) AS name,
  CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE {_lat('s_suppkey', 7, 191, 95)} END AS latitude,
  {_lon('s_suppkey', 59, 381, 190)} AS longitude
FROM supplier"""

BRONZE_P = f"""
SELECT *, md5(concat_ws('|', id, ts, user_id, destination_id)) AS _row_hash,
  'raw.travel_purchase' AS _source_table, {RUN_TS} AS _ingested_at
FROM src_p"""

BRONZE_U = f"SELECT *, 'raw.user_features' AS _source_table, {RUN_TS} AS _ingested_at FROM src_u"

BRONZE_D = f"""
SELECT * RENAME (name AS destination_name, latitude AS dest_latitude, longitude AS dest_longitude),
  'raw.destination_location' AS _source_table, {RUN_TS} AS _ingested_at
FROM src_d"""

# A value is valid where its predicate is true; NULL and NaN are not.
PRICE_OK = "(price BETWEEN 0 AND 50000)"
PLACE_OK = "(abs(user_latitude) <= 90 AND abs(user_longitude) <= 180)"
PRICE_USD = f"CASE WHEN {PRICE_OK} THEN ROUND(price, 2) END"
PRICE_INVALID = f"({PRICE_OK} IS NOT TRUE)"
LOCATION_INVALID = f"({PLACE_OK} IS NOT TRUE)"
DOW = "(isodow({0}) % 7 + 1)"
DAY_TYPE = "if(isodow({0}) >= 6, 'weekend', 'weekday')"


def clean_coord(c: str, bound: int) -> str:
    return f"CASE WHEN abs({c}) <= {bound} THEN ROUND({c}, 6) END"


# Bands: the label of the greatest lower bound that the value reaches (fixed values).
FREQUENCY = [(10, "high_frequency"), (3, "medium_frequency")]
PRICE_BANDS = [(500, "premium"), (200, "standard")]
TIERS = [(5000, "platinum"), (2000, "gold"), (500, "silver")]


def band_table(bands: list[tuple[int, str]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({least}, '{label}')" for least, label in bands) + ") b(least, label)"


SILVER_P = f"""
SELECT * EXCLUDE (id, ts, price, _source_table, _row_hash, clicked, purchased),
  id AS transaction_id, ts AS transaction_timestamp, clicked IS TRUE AS clicked, purchased IS TRUE AS purchased,
  {PRICE_USD} AS price_usd, {PRICE_INVALID} AS _price_invalid, {LOCATION_INVALID} AS _location_invalid,
  year(ts) AS transaction_year, month(ts) AS transaction_month, hour(ts) AS transaction_hour,
  {DOW.format('ts')} AS transaction_day_of_week, {DAY_TYPE.format('ts')} AS day_type, {RUN_TS} AS _processed_at
FROM bronze_p WHERE (id IS NULL OR user_id IS NULL OR destination_id IS NULL) IS FALSE"""

SILVER_U = f"""
SELECT u.user_id, u._ingested_at, {RUN_TS} AS _processed_at, u.ts AS last_updated_at,
  ROUND(ifnull(u.mean_price_7d, 0), 2) AS avg_price_7day, ifnull(u.last_6m_purchases, 0) AS purchases_6month,
  {clean_coord('u.user_latitude', 90)} AS user_latitude, {clean_coord('u.user_longitude', 180)} AS user_longitude,
  ifnull(f.label, 'low_frequency') AS purchase_frequency_segment, ifnull(p.label, 'budget') AS price_segment
FROM bronze_u u
ASOF LEFT JOIN frequency_bands f ON u.last_6m_purchases >= f.least
ASOF LEFT JOIN price_bands p ON u.mean_price_7d >= p.least
WHERE u.user_id IS NOT NULL"""

SILVER_D = f"""
SELECT destination_id, _ingested_at, {RUN_TS} AS _processed_at, trim({initcap('destination_name')}) AS destination_name,
  {clean_coord('dest_latitude', 90)} AS latitude, {clean_coord('dest_longitude', 180)} AS longitude,
  if(dest_latitude >= 0, 'Northern', 'Southern') AS hemisphere
FROM bronze_d WHERE destination_id IS NOT NULL"""

PAID = "SUM(CAST(price_usd AS DECIMAL(18,2))) FILTER (WHERE purchased)"
#: NULL only where every row is a purchase without a price.
REVENUE = f"CASE WHEN COUNT(*) > COUNT(*) FILTER (WHERE purchased AND price_usd IS NULL) THEN ifnull({PAID}, 0) END"


def tally(keys: str) -> str:
    """The fact's counts, money and times by ``keys``."""
    return f"""
SELECT {keys}, COUNT(*) AS n, COUNT(transaction_id) AS n_ids, COUNT(*) FILTER (WHERE clicked) AS clicks,
  COUNT(*) FILTER (WHERE purchased) AS bookings, {PAID} AS paid, COUNT(price_usd) FILTER (WHERE purchased) AS n_paid,
  {REVENUE} AS revenue, MIN(price_usd) FILTER (WHERE purchased) AS cheapest, MAX(price_usd) FILTER (WHERE purchased) AS dearest,
  MIN(transaction_timestamp) AS since, MAX(transaction_timestamp) AS until
FROM sale GROUP BY {keys}"""


def spread(keys: str, counted: str) -> str:
    """How many values of ``counted`` each key meets, and how many among purchases, from the distinct pairs."""
    return f"""
SELECT {keys}, COUNT({counted}) AS met, COUNT({counted}) FILTER (WHERE booked) AS met_booked
FROM (SELECT {keys}, {counted}, bool_or(purchased) AS booked FROM sale GROUP BY {keys}, {counted}) GROUP BY {keys}"""


def same(a: str, b: str, keys: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", "))


def standing(source: str, value: str) -> str:
    """Each distinct value with 1 + the number of rows above it; NULL stands below all."""
    return f"""
SELECT {value}, CAST(1 + ifnull(SUM(held) OVER (ORDER BY {value} DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
FROM (SELECT {value}, COUNT(*) AS held FROM {source} GROUP BY {value})"""


DAY = "report_date, transaction_year, transaction_month, day_type"
MONTH = "transaction_year, transaction_month"
PLACE = "destination_id, destination_name, latitude, longitude, hemisphere"
PERSON = "user_id, purchase_frequency_segment, price_segment, avg_price_7day, purchases_6month, user_latitude, user_longitude"

GOLD_DAILY = f"""
SELECT {', '.join('t.' + k for k in DAY.split(', '))}, t.n AS total_transactions, t.clicks AS total_clicks, t.bookings AS total_purchases,
  u.met AS unique_users, d.met AS unique_destinations, t.cheapest AS min_transaction_usd, t.dearest AS max_transaction_usd,
  {pct('t.bookings', 't.n')} AS conversion_rate_pct, {pct('t.bookings', 't.clicks')} AS click_to_purchase_rate_pct,
  CAST(t.revenue AS DOUBLE) AS total_revenue_usd, {avg_money('t.paid', 't.n_paid')} AS avg_transaction_value_usd, {RUN_TS} AS _generated_at
FROM ({tally(DAY)}) t
JOIN ({spread(DAY, 'user_id')}) u ON {same('t', 'u', DAY)}
JOIN ({spread(DAY, 'destination_id')}) d ON {same('t', 'd', DAY)}"""

# One row a distinct dimension row, with its copies; each copy meets the whole tally of its key.
DEST_MEASURES = f"""
SELECT g.* EXCLUDE (copies), copies * ifnull(t.n, 1) AS total_views, copies * ifnull(t.clicks, 0) AS total_clicks,
  copies * ifnull(t.bookings, 0) AS total_bookings, if(t.n IS NULL, 0, copies * t.revenue) AS revenue,
  t.paid, ifnull(t.n_paid, 0) AS n_paid, ifnull(v.met, 0) AS unique_visitors, ifnull(v.met_booked, 0) AS unique_buyers,
  t.since AS first_transaction, t.until AS last_transaction
FROM (SELECT {PLACE}, COUNT(*) AS copies FROM silver_d GROUP BY {PLACE}) g
LEFT JOIN ({tally('destination_id')}) t USING (destination_id)
LEFT JOIN ({spread('destination_id', 'user_id')}) v USING (destination_id)"""

GOLD_DEST = f"""
SELECT m.* EXCLUDE (revenue, paid, n_paid), CAST(m.revenue AS DOUBLE) AS total_revenue_usd,
  {pct('m.total_clicks', 'm.total_views')} AS click_rate_pct, {pct('m.total_bookings', 'm.total_clicks')} AS booking_rate_pct,
  {avg_money('m.paid', 'm.n_paid')} AS avg_booking_value_usd, b.place AS booking_rank, r.place AS revenue_rank, {RUN_TS} AS _generated_at
FROM dest_measures m
JOIN ({standing('dest_measures', 'total_bookings')}) b ON b.total_bookings = m.total_bookings
JOIN ({standing('dest_measures', 'revenue')}) r ON r.revenue IS NOT DISTINCT FROM m.revenue"""

USER_MEASURES = f"""
SELECT g.* EXCLUDE (copies), copies * ifnull(t.n, 1) AS n, copies * ifnull(t.n_ids, 0) AS n_ids, copies * ifnull(t.clicks, 0) AS clicks,
  copies * ifnull(t.bookings, 0) AS bookings, if(t.n IS NULL, 0, copies * t.revenue) AS spend, t.paid, ifnull(t.n_paid, 0) AS n_paid,
  ifnull(v.met, 0) AS met, ifnull(v.met_booked, 0) AS met_booked, t.since, t.until
FROM (SELECT {PERSON}, COUNT(*) AS copies FROM silver_u GROUP BY {PERSON}) g
LEFT JOIN ({tally('user_id')}) t USING (user_id)
LEFT JOIN ({spread('user_id', 'destination_id')}) v USING (user_id)"""

GOLD_USER = f"""
SELECT m.user_id, m.purchase_frequency_segment, m.price_segment, m.user_latitude, m.user_longitude,
  m.avg_price_7day AS historical_avg_price, m.purchases_6month AS historical_purchases,
  ifnull(c.label, 'bronze') AS customer_tier, CAST(m.spend AS DOUBLE) AS total_spend_usd, {avg_money('m.paid', 'm.n_paid')} AS avg_purchase_usd,
  m.n_ids AS total_interactions, m.clicks AS total_clicks, m.bookings AS total_purchases, {pct('m.bookings', 'm.n')} AS conversion_rate_pct,
  m.met AS destinations_viewed, m.met_booked AS destinations_booked, m.since AS first_activity, m.until AS last_activity,
  date_diff('day', m.since, m.until) AS engagement_days, {RUN_TS} AS _generated_at
FROM user_measures m ASOF LEFT JOIN tier_bands c ON m.spend >= c.least"""

MONTHS = f"""
SELECT t.*, u.met AS users, d.met AS destinations,
  ROW_NUMBER() OVER (ORDER BY t.transaction_year NULLS FIRST, t.transaction_month NULLS FIRST) AS place
FROM ({tally(MONTH)}) t
JOIN ({spread(MONTH, 'user_id')}) u ON {same('t', 'u', MONTH)}
JOIN ({spread(MONTH, 'destination_id')}) d ON {same('t', 'd', MONTH)}"""

GOLD_MONTHLY = f"""
SELECT m.transaction_year, m.transaction_month, m.n AS total_transactions, m.bookings AS total_bookings,
  m.users AS active_users, m.destinations AS destinations_in_demand, {pct('m.bookings', 'm.n')} AS monthly_conversion_pct,
  CAST(m.revenue AS DOUBLE) AS monthly_revenue_usd, CAST(before.revenue AS DOUBLE) AS prev_month_revenue,
  {avg_money('m.paid', 'm.n_paid')} AS avg_booking_value_usd, {RUN_TS} AS _generated_at
FROM months m LEFT JOIN months before ON before.place = m.place - 1"""


def with_layers(fixture: str, body: str) -> str:
    """Prefix ``body`` with CTEs for the sources and all ten layer tables of a fixture."""
    src_p = SRC_PURCHASE_A if fixture.upper() == "A" else SRC_PURCHASE_B
    sale = "SELECT *, date_trunc('day', transaction_timestamp)::TIMESTAMP AS report_date FROM silver_p"
    ctes = [
        ("src_p", src_p), ("src_u", SRC_USERS), ("src_d", SRC_DESTINATIONS),
        ("frequency_bands", band_table(FREQUENCY)), ("price_bands", band_table(PRICE_BANDS)), ("tier_bands", band_table(TIERS)),
        ("bronze_p", BRONZE_P), ("bronze_u", BRONZE_U), ("bronze_d", BRONZE_D),
        ("silver_p", SILVER_P), ("silver_u", SILVER_U), ("silver_d", SILVER_D), ("sale", sale),
        ("gold_daily", GOLD_DAILY), ("dest_measures", DEST_MEASURES), ("gold_dest", GOLD_DEST),
        ("user_measures", USER_MEASURES), ("gold_user", GOLD_USER), ("months", MONTHS), ("gold_monthly", GOLD_MONTHLY),
    ]
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in ctes) + "\n" + body


# ---------------------------------------------------------------------------
# Data-quality checks
# ---------------------------------------------------------------------------
def _check(actual: str, check: str, expected: str, layer: str, status: str, table: str, source: str) -> str:
    return (f"SELECT CAST({actual} AS VARCHAR) AS actual, '{check}' AS \"check\", '{expected}' AS expected, "
            f"'{layer}' AS layer, {status} AS status, '{table}' AS \"table\" FROM {source}")


LAYER_CTES = [
    ("bronze_travel_purchases", "bronze", "bronze_p"),
    ("bronze_user_features", "bronze", "bronze_u"),
    ("bronze_destinations", "bronze", "bronze_d"),
    ("silver_travel_purchases", "silver", "silver_p"),
    ("silver_users", "silver", "silver_u"),
    ("silver_destinations", "silver", "silver_d"),
    ("gold_daily_revenue_metrics", "gold", "gold_daily"),
    ("gold_destination_performance", "gold", "gold_dest"),
    ("gold_user_engagement", "gold", "gold_user"),
    ("gold_monthly_summary", "gold", "gold_monthly"),
]

DQ_RECORD_COUNTS = "\nUNION ALL\n".join(
    _check("COUNT(*)", "record_count", "> 0", layer,
           "CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END", name, cte)
    for name, layer, cte in LAYER_CTES
)


def _orphans(key: str, dim: str, label: str) -> str:
    n = f"COUNT(DISTINCT t.{key})"
    return _check(n, "referential_integrity", "0 orphans", "silver",
                  f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'WARN' END", label,
                  f"silver_p t LEFT JOIN {dim} x ON t.{key} = x.{key} WHERE x.{key} IS NULL")


DQ_REFERENTIAL = (
    _orphans("user_id", "silver_u", "silver_travel_purchases -> silver_users")
    + "\nUNION ALL\n"
    + _orphans("destination_id", "silver_d", "silver_travel_purchases -> silver_destinations")
)


def dq_freshness(as_of: str = AS_OF) -> str:
    parts = []
    for name, col, cte in [
        ("bronze_travel_purchases", "_ingested_at", "bronze_p"),
        ("silver_travel_purchases", "_processed_at", "silver_p"),
        ("gold_daily_revenue_metrics", "_generated_at", "gold_daily"),
    ]:
        age = f"((epoch_us({as_of}) - epoch_us(MAX({col}))) / 3.6e9)"
        actual = f"CASE WHEN MAX({col}) IS NULL THEN 'inf hours' ELSE printf('%.1f hours', {age}) END"
        status = f"CASE WHEN {age} < 24 THEN 'PASS' ELSE 'WARN' END"
        parts.append(_check(actual, "data_freshness", "< 24 hours", name.split("_")[0], status, name, cte))
    return "\nUNION ALL\n".join(parts)


DQ_BUSINESS = (
    _check("COUNT(*)", "business_rule", "0 negative prices", "silver",
           "CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END", "silver_travel_purchases",
           "silver_p WHERE price_usd < 0")
    + "\nUNION ALL\n"
    + _check("COUNT(*)", "business_rule", "0 invalid rates", "gold",
             "CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END", "gold_daily_revenue_metrics",
             "gold_daily WHERE conversion_rate_pct < 0 OR conversion_rate_pct > 100")
)


def dq_audit_log(as_of: str = AS_OF) -> str:
    return "\nUNION ALL\n".join([DQ_RECORD_COUNTS, DQ_REFERENTIAL, dq_freshness(as_of), DQ_BUSINESS])


def dq_summary(as_of: str = AS_OF) -> str:
    return f"""
SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS pass_count,
  COUNT(*) FILTER (WHERE status = 'WARN') AS warn_count,
  COUNT(*) FILTER (WHERE status = 'FAIL') AS fail_count,
  COUNT(*) AS total_count,
  CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM ({dq_audit_log(as_of)}) audit"""
