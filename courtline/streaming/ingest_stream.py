"""Incremental ingest as a Structured Streaming job.

New response files land in a folder; each micro-batch is parsed, normalised
and upserted by key into a stored table (``sources.keyed_table``): a batch
rewrites the buckets its keys fall in, under its own version.  A batch that was
committed before a failure is left alone when it is run again; the stream's
checkpoint records which files were consumed.  Readers take the newest
committed version.

``upsert_batch`` writes the older layout, a whole table for each version;
``read_latest`` reads both.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtline.operators.upsert import last_wins, upsert
from courtline.sources import keyed_table
from courtline.sources.ingest import parse_responses, usable

RESPONSE_SCHEMA = "request_type string, content_type string, body string, seq long"


def committed(spark: SparkSession, base: str) -> list[int]:
    """Versions whose write was committed (their folder holds the mark that is written last), oldest first.

    Only a folder that is not there counts as "no table yet"; any other failure to read is raised.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for f in fs.listStatus(path):
        name = f.getPath().getName()
        if name.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
            out.append(int(name.partition("=")[2]))
    return sorted(out)


def read_latest(spark: SparkSession, base: str, below: int | None = None) -> DataFrame | None:
    """Newest committed version (below a given one), or None if there is none."""
    keyed = keyed_table.latest(spark, base, below)
    if keyed is not None:
        return keyed_table.read(spark, base, keyed.version)
    found = [v for v in committed(spark, base) if below is None or v < below]
    return spark.read.parquet(f"{base}/version={found[-1]}") if found else None


def upsert_batch(spark: SparkSession, batch: DataFrame, base: str, version: int,
                 keys: Sequence[str], seq: str) -> None:
    """Merge one batch into the newest committed version below ``version`` and write it as ``version``.

    A replayed batch starts from the same version as it did first, so it
    writes the same rows again.
    """
    current = read_latest(spark, base, below=version)
    batch = batch.withColumn("ingested_at", F.current_timestamp())
    if current is None:
        new = last_wins(batch, keys, [seq])
    else:
        new = upsert(current, batch.select(*current.columns), keys, seq, F.current_timestamp())
    new.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
        f"{base}/version={version}")


def start_ingest(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str,
                 node: str, fields: Sequence[str],
                 normalise: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                 seq: str = "seq", available_now: bool = True,
                 required: Sequence[str] = (), buckets: int = keyed_table.BUCKETS) -> StreamingQuery:
    """Stream JSON-lines response files from ``source_dir`` into the keyed table at ``table_dir``.

    ``normalise`` maps parsed records (column ``rec`` plus the response's
    columns) to typed rows that keep the ``seq`` column.
    """
    stream = spark.readStream.schema(RESPONSE_SCHEMA).json(source_dir)

    def apply(batch: DataFrame, batch_id: int) -> None:
        recs = usable(parse_responses(batch, node, fields), required)
        rows = normalise(recs)
        keyed_table.upsert_stored(spark, table_dir, rows, batch_id, keys, seq, F.current_timestamp(), buckets)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def with_seq(normalised: DataFrame, seq: Column) -> DataFrame:
    return normalised.withColumn("seq", seq)
