"""Session settings shared by the library, the tests and the bench.

The library never creates a session on its own: every operator takes the
caller's DataFrames.  ``get_session`` is a convenience for scripts/tests that
applies the settings the operators are designed around (ANSI casts, UTC,
adaptive execution with skew handling, no UI).
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every run relies on.  Shuffle partitions are sized by the caller:
# on a cluster leave it to AQE's coalescing (start high, advisory size 128 MB).
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied.  What was
    submitted (``--conf``) stays as it is; ``shuffle_partitions`` and ``extra``
    are the caller's own wishes and are set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    conf = {k: v for k, v in BASE_CONF.items() if not submitted.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (set by the cluster config).
    Only in local mode a scratch folder is created and registered when nothing
    is configured; on a cluster that raises, as executors share no such folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="starkit-ckpt-", dir=os.environ.get("STARKIT_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


MAX_SHUFFLE_PARTITIONS = 40_000


def scale_settings(input_bytes: int, cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a run over ``input_bytes`` on ``cores`` executor cores.

    * scans: splits of ``target_partition_bytes`` (128 MB), so a task's
      input fits in its memory share;
    * shuffles: start with one partition per ~128 MB of input (at least
      2 per core) and let AQE coalesce small ones and split skewed ones;
      above MAX_SHUFFLE_PARTITIONS partitions grow in size instead, as the
      driver tracks a block for each pair of map and reduce tasks.
    """
    initial = max(2 * cores, min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
