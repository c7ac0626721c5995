"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_PARTITIONS (default = cores),
BENCH_RUNS (default 3; the median of the warm runs is reported).

Every query runs from the parquet tables (fixture derivation, bronze, silver,
gold) and is fully executed with the ``noop`` sink, so nothing is collected.
``all_layers_end_to_end_b`` times ``run_pipeline`` (write and read back all ten tables, 17 checks, audit
log); this extra is not in ``value``.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from traveltiers.operators import quality  # noqa: E402
from traveltiers.plans.layers import AS_OF, RUN_TS, Layers  # noqa: E402
from traveltiers.plans.pipeline import run_pipeline  # noqa: E402
from traveltiers.session import get_session  # noqa: E402
from traveltiers.sources.fixtures import fixture  # noqa: E402
from traveltiers.sources.sink import TableSink  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def sf_of(path: str) -> str:
    base = os.path.basename(os.path.normpath(path))
    return base[2:] if base.startswith("sf") else base


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_stats(log_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """Shuffle bytes written and jobs started per job group, from Spark's event log."""
    stage_group: dict[int, str] = {}
    jobs: dict[str, int] = {}
    written: dict[str, float] = {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path):
            continue
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        jobs[group] = jobs.get(group, 0) + 1
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    w = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if group:
                        written[group] = written.get(group, 0) + w
    return written, jobs


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="traveltiers-bench-events-")
    spark = get_session(
        f"local[{CPUS}]",
        app="traveltiers-bench",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_PARTITIONS", str(max(4, CPUS))),
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": os.environ.get("BENCH_EVENTLOG", "true"),
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def layers(fix: str) -> Layers:
        return Layers(fixture(spark, SF_DIR, fix))

    def audit_log():
        shared = Layers(fixture(spark, SF_DIR, "A"), share=True)
        return quality.quality_checks(spark, shared.tables(), AS_OF, shared.daily_partials)

    headline = {
        "silver_travel_purchases_b": lambda: layers("B").silver_travel_purchases,
        "gold_daily_revenue_metrics_a": lambda: layers("A").gold_daily_revenue_metrics,
        "gold_daily_revenue_metrics_b": lambda: layers("B").gold_daily_revenue_metrics,
        "gold_destination_performance_b": lambda: layers("B").gold_destination_performance,
        "gold_user_engagement_b": lambda: layers("B").gold_user_engagement,
        "gold_monthly_summary_b": lambda: layers("B").gold_monthly_summary,
        "dq_audit_log_a": audit_log,
    }
    sink_root = tempfile.mkdtemp(prefix="traveltiers-bench-tables-")

    def all_layers():
        """Writes all ten tables and the audit log (eager); the noop runner gets an empty frame."""
        sink = TableSink(spark, database="traveltiers_bench", root=sink_root)
        run_pipeline(spark, fixture(spark, SF_DIR, "B"), sink, run_ts=RUN_TS, as_of=AS_OF,
                     raise_on_failure=False)
        return spark.range(0)

    extra = {
        "all_layers_end_to_end_b": all_layers,
    }

    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    todo = {n: b for n, b in {**headline, **extra}.items() if not only or n in only}
    times: dict[str, float] = {}
    for name, build in todo.items():
        samples = []
        for i in range(RUNS + 1):  # first run warms the JVM and file caches
            spark.sparkContext.setJobGroup(f"{name}#{i}", name)
            t0 = time.perf_counter()
            run_noop(build())
            dt = time.perf_counter() - t0
            if i > 0 or RUNS == 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
        print(name, [round(x, 2) for x in samples], file=sys.stderr)

    total = round(sum(times[n] for n in headline if n in times), 3)
    spark.stop()
    try:
        written, jobs = shuffle_stats(log_dir)
    except Exception as e:  # the timing line must still be printed
        print(f"event log not read: {e}", file=sys.stderr)
        written, jobs = {}, {}
    last = f"#{RUNS}"
    shuffle_mb = {n: round(written.get(n + last, 0) / 2**20, 2) for n in times}
    job_count = {n: jobs.get(n + last, 0) for n in times}
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf_of(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
        "shuffle_mb": shuffle_mb,
        "jobs": job_count,
    }))


if __name__ == "__main__":
    main()
