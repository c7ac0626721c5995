"""Batch job entry point: ``spark-submit -m``-style runner for the whole pipeline.

    spark-submit traveltiers/plans/job.py --source-schema raw --target-schema travel \\
        --root s3://bucket/warehouse/travel

or, on the driver's test tables, ``--sf-dir /root/testdata/sf0.1 --fixture B``.
Exit status is non-zero when the quality gate fails (after the audit log is written).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from traveltiers.operators.quality import DataQualityError  # noqa: E402
from traveltiers.plans.pipeline import LAYERS, run_pipeline  # noqa: E402
from traveltiers.session import cluster_conf, get_session  # noqa: E402
from traveltiers.sources.fixtures import catalog_sources, fixture  # noqa: E402
from traveltiers.sources.sink import TableSink  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="bronze -> silver -> gold -> quality gate")
    ap.add_argument("--source-schema", default="raw", help="catalog schema holding the three source tables")
    ap.add_argument("--target-schema", default="traveltiers", help="catalog schema for the layer tables")
    ap.add_argument("--root", default=None, help="storage folder of the layer tables (default: the schema's own location)")
    ap.add_argument("--sf-dir", default=None, help="read a test-data folder instead of the catalog")
    ap.add_argument("--fixture", default="A", help="fixture to derive from --sf-dir (A or B)")
    ap.add_argument("--run-ts", default=None, help="pin the audit timestamp (default: now)")
    ap.add_argument("--as-of", default=None, help="freshness reference time (default: now)")
    ap.add_argument("--partition-silver", action="store_true", help="partition the silver fact by year/month")
    ap.add_argument("--refresh", action="store_true", help="daily tables: write only the days whose facts have changed")
    ap.add_argument("--input-gb", type=float, default=None, help="size of the sources; with --cores sets partition sizes")
    ap.add_argument("--cores", type=int, default=None, help="cores of the whole cluster")
    ap.add_argument("--executor-memory-gb", type=float, default=16.0, help="memory of an executor")
    ap.add_argument("--executor-cores", type=int, default=4, help="cores of an executor")
    ap.add_argument("--layers", default=",".join(LAYERS), help="layers to run, separated by commas; each reads what those before have written")
    args = ap.parse_args(argv)
    layers = [x.strip() for x in args.layers.split(",") if x.strip()]
    if set(layers) - set(LAYERS):
        ap.error(f"--layers takes {', '.join(LAYERS)}")
    if (args.input_gb is None) != (args.cores is None):
        ap.error("--input-gb and --cores go together")

    conf = {} if args.cores is None else cluster_conf(
        int(args.input_gb * 1e9), args.cores, args.executor_memory_gb, args.executor_cores)
    spark = get_session(**conf)
    src = None
    if "bronze" in layers:
        src = fixture(spark, args.sf_dir, args.fixture) if args.sf_dir else catalog_sources(spark, args.source_schema)
    sink = TableSink(spark, database=args.target_schema, root=args.root)
    try:
        result = run_pipeline(spark, src, sink, run_ts=args.run_ts, as_of=args.as_of,
                              source_schema=args.source_schema, partition_silver=args.partition_silver, layers=layers,
                              refresh=args.refresh)
    except DataQualityError as e:
        print(json.dumps({"status": "FAIL", "error": str(e), "rows_written": sink.written}))
        return 1
    print(json.dumps({"status": result.status, "rows_written": result.rows_written, "report": result.report},
                     default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
