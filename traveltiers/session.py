"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "traveltiers", **conf: str) -> SparkSession:
    """A session with UTC time, AQE (coalescing and skew-join splitting) and no UI.

    On a cluster leave ``master`` unset so the launcher decides; pass
    ``spark.sql.shuffle.partitions`` sized to the data through ``conf``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SESSION_CONF, **conf}.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (as in tests) gets a
    private temporary folder; a cluster session without it is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="traveltiers-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path for written intermediate tables inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", *parts)


MB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, executor_memory_gb: float = 16.0,
                 cores_per_executor: int = 4) -> dict[str, str]:
    """Starting partition sizes for a large cluster (pass them to the launcher with ``--conf``).

    * Scan splits of 256 MB: ~400k scan tasks for 100 TB, each well inside the
      per-task execution memory (executor memory x 0.6 / cores; 2.4 GB for 16 GB / 4 cores).
    * Shuffles here move pruned columns after map-side partial aggregation, about a
      tenth of the scanned bytes at most; the initial shuffle partition count targets
      128 MB per partition on that estimate, at least 2x the cores, and AQE coalesces small partitions
      and splits skewed ones at run time.
    * Broadcasts only from measured sizes: planning-time broadcasts (which trust
      size estimates that can be off by the parquet compression ratio) are off,
      and AQE converts a join to a broadcast once a side's shuffle output is
      known to be under 64 MB. Every dimension join here has both sides
      aggregated (shuffled) anyway, so nothing is lost.
    """
    per_task = executor_memory_gb * 1024 * MB * 0.6 / max(1, cores_per_executor)
    split = int(min(256 * MB, per_task / 4))
    shuffle_estimate = input_bytes / 10
    partitions = int(max(2 * total_cores, shuffle_estimate // (128 * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        # Coalesce to the advisory size rather than to the core count (large, busy clusters).
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
