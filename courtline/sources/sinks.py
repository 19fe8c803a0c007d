"""Sinks: CSV / JSON export (S11) and table writes.

Files go under the cluster's shared checkpoint folder (``spark.checkpoint.dir``)
unless a path is given; never under a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from courtline.session import ensure_checkpoint_dir


def scratch_path(df: DataFrame, name: str) -> str:
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{base}/courtline-exports/{name}-{uuid.uuid4().hex}"


def export_csv(df: DataFrame, path: str | None = None, name: str = "export") -> str:
    """Write ``df`` as CSV with a header; returns the folder."""
    path = path or scratch_path(df, name)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(df: DataFrame, path: str | None = None, name: str = "export") -> str:
    """Write ``df`` as JSON lines; returns the folder."""
    path = path or scratch_path(df, name)
    df.write.mode("overwrite").json(path)
    return path


def csv_roundtrip(df: DataFrame, name: str = "export") -> DataFrame:
    """Export as CSV and read it back with the original schema."""
    path = export_csv(df, name=name)
    return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a table as parquet.  ``overwrite`` is the full reload (S7), ``append`` S6.

    An upsert result replaces its table by writing a new version folder and
    pointing readers at it (a folder being read cannot be overwritten in the
    same job); with ``partition_by`` and dynamic partition overwrite only the
    touched partitions are rewritten.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
