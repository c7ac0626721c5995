"""Every registered query against its DuckDB oracle (the driver's correctness gate) at sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare


def test_all_registered_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, verbose=True)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    assert not bad, bad
    assert len(res) >= 60


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 30
    assert "total_revenue_usd" in df.columns
