"""Reusable ``Column`` builders (rules, rates, money, hashing)."""

from traveltiers.functions.rules import (  # noqa: F401
    audit_ts,
    avg_cents,
    band,
    cents,
    clean_coordinate,
    clean_latitude,
    clean_longitude,
    clean_price,
    customer_tier,
    day_type,
    default_false,
    floor_div,
    frequency_segment,
    hemisphere,
    location_invalid,
    money_from_cents,
    normalize_name,
    pct,
    price_invalid,
    price_segment,
    row_hash,
)
