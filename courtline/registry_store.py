"""The registered queries' own table store: they share stored raw tables and models."""

from __future__ import annotations

from pyspark.sql import SparkSession

from courtline.league import League
from courtline.sources.league import TableStore

TABLES = TableStore()


def league(spark: SparkSession, sf_dir: str, method: str = "fill") -> League:
    return League.from_testdata(spark, sf_dir, method, TABLES)
