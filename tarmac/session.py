"""Session helpers.

Library code never creates a session; it takes the one it is given. These
helpers build a local session for tests and the benchmark, and resolve the
shared checkpoint folder from the session's own configuration.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE coalesces small shuffle
# partitions, splits skewed ones and turns small join sides into broadcasts
# at runtime, after it has measured them.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Local runs only: test inputs are a few MB, so AQE's default 1 MB minimum
# coalesced partition would leave the CPU-bound stages (regexes, hashing,
# window sorts) on two or three of the eight cores.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tarmac") -> SparkSession:
    """A local[N] session for tests and benchmarks."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.driver.memory", os.environ.get("TARMAC_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**SESSION_DEFAULTS, **LOCAL_DEFAULTS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is; without it the job stops with a clear error, since a folder
    of the driver's own machine cannot be seen by executors. A local session
    (``local[N]``: one machine, one JVM) gets a fresh scratch folder instead.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share: intermediate tables are written there")
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured
