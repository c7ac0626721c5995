"""Physical-plan properties the scale design relies on (read from ``explain``)."""

import contextlib
import io

import pytest

from tests.conftest import SF_MID
from traveltiers.plans.layers import Layers
from traveltiers.sources.fixtures import fixture


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def layers_b(spark):
    return Layers(fixture(spark, SF_MID, "B"))


def test_scan_pushdown_and_pruning(layers_b):
    p = plan(layers_b.silver_travel_purchases)
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber), IsNotNull(l_suppkey)]" in p
    read = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<l_")][0]
    assert "l_partkey" not in read and "l_quantity" not in read and "l_tax" not in read


def test_silver_is_narrow(layers_b):
    p = plan(layers_b.silver_travel_purchases)
    # Only the fixture's own join/spread exchanges; the silver rules add no shuffle or aggregate.
    assert "HashAggregate" not in p and "Window" not in p


@pytest.mark.parametrize("table", ["destination_metrics", "gold_user_engagement"])
def test_eager_aggregation_has_no_expand(layers_b, table):
    p = plan(getattr(layers_b, table))
    assert "Expand" not in p
    assert "SortMergeJoin LeftOuter" in p or "BroadcastHashJoin LeftOuter" in p


def test_fact_is_aggregated_before_the_join(layers_b):
    p = plan(layers_b.gold_user_engagement)
    join_at = p.index("LeftOuter")
    # Partial aggregation on (user_id, destination_id) appears in the subtree under the join.
    assert "Keys [2]: [user_id" in p[p.index("Physical Plan"):] and join_at > 0


def test_monthly_window_runs_on_aggregated_rows(layers_b):
    p = plan(layers_b.gold_monthly_summary)
    tree = p.split("\n\n")[0]
    assert tree.index("Window") < tree.index("HashAggregate")  # the window sits above the aggregate


def test_first_fact_shuffle_is_keyed_by_pair(layers_b):
    """A hot destination (or user) is spread over reducers: the fact's first exchange hashes
    on (key, other) after map-side partial aggregation, never on the key alone."""
    import re
    p = plan(layers_b.destination_metrics)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", p)
    pair = [e for e in exchanges if e.startswith("destination_id") and "user_id" in e]
    assert pair, exchanges
    p = plan(layers_b.gold_user_engagement)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", p)
    assert any(e.startswith("user_id") and "destination_id" in e for e in exchanges), exchanges


@pytest.mark.parametrize("table", ["silver_travel_purchases", "gold_daily_revenue_metrics",
                                   "destination_metrics", "gold_user_engagement"])
def test_operators_run_in_whole_stage_codegen(layers_b, table):
    """After execution, every project/filter/aggregate/expand/join of the final AQE plan is codegen'd."""
    df = getattr(layers_b, table)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    ops = [ln for ln in final.splitlines()
           if any(k in ln for k in ("Project [", "HashAggregate(", "Filter ", "Expand [",
                                    "BroadcastHashJoin", "SortMergeJoin"))]
    assert ops and all("*(" in ln for ln in ops), [ln.strip()[:80] for ln in ops if "*(" not in ln]


def test_ranks_read_the_fact_once(layers_b):
    """The metrics hold the only scan of the fact; the ranks stand on their materialised rows, through one rank table."""
    assert plan(layers_b.destination_metrics).count("ReadSchema: struct<l_") == 1
    perf = layers_b.gold_destination_performance
    assert "ReadSchema" not in plan(perf)
    perf.collect()
    final = perf._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Window [") == 1 and "ReusedExchange" in final


def test_orphan_checks_read_the_fact_once(layers_b):
    from traveltiers.operators import quality

    checks = quality.referential_integrity_checks(layers_b.tables())
    p = plan(checks)
    assert p.count("ReadSchema: struct<l_") == 1 and "LeftAnti" not in p
    p = plan(quality.table_checks(checks.sparkSession, [quality.TablePart(layers_b.silver_users, "silver_users", "silver"),
                                                        quality.TablePart(layers_b.silver_destinations, "silver_destinations", "silver")]))
    assert p.split("\n\n")[0].count("Exchange") == 2  # one grouped aggregate, and the layout of its rows
