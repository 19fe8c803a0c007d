"""Where operators put intermediate tables, and how Arrow batches are sized.

Intermediates are parquet tables in the shared folder named by
``spark.checkpoint.dir`` (see ``session.ensure_checkpoint_dir``): they cut
lineage, survive lost executors and are readable from every machine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from courtline.session import ensure_checkpoint_dir

#: One Arrow batch handed to Python holds at most this many rows and about this many bytes.
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes, so that a run of long texts can't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def new_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
