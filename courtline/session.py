"""Session helpers.

Library functions never create sessions; they take DataFrames.  These helpers
are for entry points (tests, bench, scripts) and for the few settings the
results depend on (session time zone).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings a correct result depends on.  Applied to any session handed to us.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # of a JSON object's repeated key the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for throughput; the cluster may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC), leave everything else alone."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "courtline") -> SparkSession:
    """A local[N] session for tests and the bench (never used on a cluster)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.driver.memory", os.environ.get("COURTLINE_DRIVER_MEMORY", "16g")))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; unset
    there, this is an error, since a folder of one machine would hold a part of
    every table.  Only a local session (tests, bench) gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="courtline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
