"""Write docs/PLANS.md: the physical plan trees of the main tables (fixture B, sf0.1 by default)."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from traveltiers.operators import quality  # noqa: E402
from traveltiers.plans.layers import AS_OF, Layers  # noqa: E402
from traveltiers.session import get_session  # noqa: E402
from traveltiers.sources.fixtures import fixture  # noqa: E402


def tree(df) -> str:
    """The plan tree plus one line per exchange (partitioning) and per scan (filters, columns)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    blocks = text.split("\n\n")
    lines = [blocks[0], ""]
    for b in blocks[1:]:
        head = b.strip().splitlines()[0] if b.strip() else ""
        fields = dict(ln.split(": ", 1) for ln in b.strip().splitlines()[1:] if ": " in ln)
        if head.split(" ")[1:2] == ["Exchange"] or " Exchange" in head:
            lines.append(f"{head}: {fields.get('Arguments', '')[:160]}")
        elif "Scan parquet" in head:
            lines.append(f"{head}: PushedFilters {fields.get('PushedFilters', '[]')[:120]}; "
                         f"ReadSchema {fields.get('ReadSchema', '')[:160]}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    L = Layers(fixture(spark, sf, "B"))
    A = Layers(fixture(spark, sf, "A"))
    items = [
        ("silver_travel_purchases (fixture B)", "Narrow: one filter + project over the fixture scan/join.",
         L.silver_travel_purchases),
        ("gold_daily_revenue_metrics", "Distinct counts through Spark's rewrite: Expand, partial aggregate, "
         "shuffle on (day keys, column, gid), then a small per-day shuffle.", L.gold_daily_revenue_metrics),
        ("destination metrics (before ranks)", "Eager aggregation: fact aggregated by (destination, user) then "
         "by destination; dimension grouped with multiplicity; one left join on aggregated rows.",
         L.destination_metrics),
        ("gold_user_engagement", "Same pattern keyed by (user, destination).", L.gold_user_engagement),
        ("gold_monthly_summary", "LAG window over the aggregated months only.", L.gold_monthly_summary),
        ("gold_destination_performance", "Ranks over the materialised metrics: one value histogram, counts by prefix, one window over the children "
         "of a prefix, and one rank table joined through one key.", L.gold_destination_performance),
        ("quality checks (fixture A, lazily over all layers)", "One grouped aggregate over the tagged rows of all tables, and the orphan checks from one pass over the fact's id sets.",
         quality.quality_checks(spark, A.tables(), AS_OF)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (Spark {spark.version}, AQE on; the final "
           "plan may change at run time: coalesced partitions, broadcast conversions, skew splits).", ""]
    for title, note, df in items:
        out += [f"## {title}", "", note, "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
