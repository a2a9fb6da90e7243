"""Session helpers.

The library never creates a session on its own; callers pass theirs.  These
helpers exist for tests, the benchmark and the driver contract.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator assumes: UTC dates, ANSI arithmetic, AQE re-planning
# (coalescing, skew-join splitting, runtime broadcast of small sides).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoint files of materialised intermediates are removed once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # broadcast only genuinely small tables: a broadcast is collected on the
    # driver and rebuilt on every executor; above ~1 MB a shuffle join is
    # cheaper here and is the plan these joins take at scale anyway
    "spark.sql.autoBroadcastJoinThreshold": str(1 << 20),
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tillsight",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session (tests, benchmarks) may fall back to a fresh
    temporary folder; on a cluster a machine-local folder would not be
    visible to other executors, so an unset directory is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(operators materialise intermediates there)")
        configured = tempfile.mkdtemp(prefix="tillsight-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bench_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", "8"))
