"""Reading the driver's parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class LazyTables(Mapping):
    """Tables by name, each made when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
