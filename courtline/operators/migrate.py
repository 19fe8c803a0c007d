"""Upgrades of stored raw tables to a newer layout.

The difference of two layouts becomes an ordered list of steps: add columns,
retype columns, drop columns that were given up by name, put the columns in
order, then check the key.  ``upgrade`` checks all steps in one pass over the
table before anything is written, and refuses what would lose data: a value
that does not come back from its new type as it was, a column the new layout
does not have, a key with a null or twice the same.  Nothing is changed in
place: ``upgrade_table`` writes a new table and leaves the old one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampType

from courtline.sources.schemas import RAW_KEYS, RAW_SCHEMAS

#: Columns every raw table has beside its own.
COMMON = (StructField("payload", StringType()), StructField("ingested_at", TimestampType()))


@dataclass(frozen=True)
class Step:
    kind: str                      # add, retype, drop, order, key
    column: str                    # key and order: all columns concerned, comma-joined
    before: str | None = None
    after: str | None = None


class LossyUpgrade(ValueError):
    """What an upgrade would lose: rows by step."""

    def __init__(self, table: str, losses: Mapping[str, int]):
        self.losses = dict(losses)
        super().__init__(f"{table}: " + "; ".join(f"{what}: {n} rows" for what, n in losses.items()))


def layout(table: str, common: Sequence[StructField] = COMMON) -> StructType:
    """The present layout of a raw table."""
    return StructType([*RAW_SCHEMAS[table].fields, *common])


def steps(have: StructType, want: StructType, key: Sequence[str] = (), dropped: Sequence[str] = ()) -> list[Step]:
    """The ordered upgrade from ``have`` to ``want``.  ``dropped``: columns that may go."""
    old = {f.name: f.dataType for f in have.fields}
    new = {f.name: f.dataType for f in want.fields}
    extra = [n for n in old if n not in new and n not in dropped]
    if extra:
        raise LossyUpgrade("columns", {f"{n} is not in the new layout": -1 for n in extra})
    out = [Step("add", n, None, t.simpleString()) for n, t in new.items() if n not in old]
    out += [Step("retype", n, old[n].simpleString(), t.simpleString()) for n, t in new.items() if n in old and old[n] != t]
    out += [Step("drop", n, old[n].simpleString()) for n in old if n not in new]
    if [n for n in old if n in new] != [n for n in new if n in old] or (out and list(new) != list(old)):
        out.append(Step("order", ",".join(new)))
    if key:
        out.append(Step("key", ",".join(key)))
    return out


def _lost(name: str, before: DataType, after: DataType) -> Column:
    """Whether a value would not come back as it was."""
    there = F.col(name).try_cast(after)
    return ~there.try_cast(before).eqNullSafe(F.col(name)) | (there.isNull() & F.col(name).isNotNull())


def losses(df: DataFrame, want: StructType, key: Sequence[str] = ()) -> dict[str, int]:
    """Rows that each retyping would damage, rows with a null in the key, and keys that occur twice (those above 0)."""
    retyped = [f for f in want.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    counts = [F.count_if(_lost(f.name, df.schema[f.name].dataType, f.dataType)).alias(f"{f.name} as {f.dataType.simpleString()}") for f in retyped]
    known = [k for k in key if k in df.columns]
    if known:
        empty = F.lit(False)
        for k in known:
            empty = empty | F.col(k).isNull()
        counts.append(F.count_if(empty).alias("null in the key"))
    out = df.agg(*counts).first().asDict() if counts else {}
    if len(known) < len(key):
        out["key column missing"] = df.count()
    if known and not out["null in the key"]:
        types = {f.name: f.dataType for f in want.fields}
        again = df.groupBy(*[F.col(k).try_cast(types[k]).alias(k) for k in known]).count().filter("count > 1")
        out["key twice"] = again.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return {what: n for what, n in out.items() if n}


def upgrade(df: DataFrame, want: StructType, key: Sequence[str] = (), dropped: Sequence[str] = (),
            defaults: Mapping[str, Column] | None = None, table: str = "table") -> DataFrame:
    """``df`` in the layout ``want``; raises LossyUpgrade if data would be lost.

    Added columns are NULL, or what ``defaults`` says by name.
    """
    steps(df.schema, want, key, dropped)
    found = losses(df, want, key)
    if found:
        raise LossyUpgrade(table, found)
    given = defaults or {}
    return df.select(*[(F.col(f.name) if f.name in df.columns else given.get(f.name, F.lit(None))).try_cast(f.dataType).alias(f.name) for f in want.fields])


def upgrade_table(spark: SparkSession, old: str, new: str, table: str, dropped: Sequence[str] = (),
                  defaults: Mapping[str, Column] | None = None) -> list[Step]:
    """Write the raw table stored at ``old`` in its present layout to ``new``; returns the steps taken."""
    df = spark.read.parquet(old)
    want, key = layout(table), RAW_KEYS[table]
    upgrade(df, want, key, dropped, defaults, table).write.mode("errorifexists").parquet(new)
    return steps(df.schema, want, key, dropped)
