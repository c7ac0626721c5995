"""Sources (parquet scans, derived fixtures) and sinks (table writes)."""

from traveltiers.sources.fixtures import Sources, fixture, fixture_a, fixture_b  # noqa: F401
from traveltiers.sources.tables import read_table, resolve  # noqa: F401
