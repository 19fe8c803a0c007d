"""Filtered previews, per-group caps and first-and-last samples.

These are the operators where a row limit *is* the feature.  Each limit is
applied after a total order so the result is deterministic, and none of
them moves an unbounded set of rows into one task: global top-k uses
Spark's per-partition top-k (TakeOrderedAndProject), per-group caps use
``row_number`` with a partial group limit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def type_category(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, _NUMERIC):
        return "numeric"
    if isinstance(dt, _DATETIME):
        return "datetime"
    return "other"


def typed_predicate(df: DataFrame, column: str, value: Any) -> Column | None:
    """One filter chosen by the column's type (the table browser's rules).

    string: case-insensitive substring; numeric: inclusive (lo, hi);
    datetime: inclusive (from, to) on the date; other: lower(trim(text)) equals.
    An empty value adds no filter.
    """
    c = F.col(column)
    cat = type_category(df.schema[column].dataType)
    if value is None or value == "":
        return None
    if cat == "string":
        return c.cast("string").ilike(f"%{value}%")
    if cat == "numeric":
        lo, hi = value
        return (c >= F.lit(lo)) & (c <= F.lit(hi))
    if cat == "datetime":
        lo, hi = value
        d = F.to_date(c)
        return (d >= F.lit(lo).cast("date")) & (d <= F.lit(hi).cast("date"))
    return F.lower(F.trim(c.cast("string"))) == str(value).strip().lower()


def typed_filter(df: DataFrame, filters: Sequence[tuple[str, Any]], limit: int | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """AND of typed predicates, then an ordered LIMIT (the preview)."""
    out = df
    for column, value in filters:
        p = typed_predicate(df, column, value)
        if p is not None:
            out = out.filter(p)
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def rows_capped(df: DataFrame, group: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """The first ``max(1, cap)`` rows of each group under ``order``."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= max(1, cap)).drop("_rn"))


def head_tail_sample(df: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    """All rows if there are at most ``limit``; else the first ``limit // 2``
    and the last ``limit - limit // 2`` under ``order`` (a total order).

    Adds ``total`` (row count, a scalar subquery), ``part`` ('head'/'tail')
    and ``pos`` (1-based position from its end).  Only ``limit`` rows per
    side are ever ranked together.
    """
    n_first = limit // 2
    n_last = limit - n_first
    total = df.select(F.count(F.lit(1))).scalar()
    asc = [F.col(c).asc() for c in order]
    desc = [F.col(c).desc() for c in order]
    head = (df.orderBy(*asc).limit(limit)
            .withColumn("pos", F.row_number().over(Window.orderBy(*asc))))
    tail = (df.orderBy(*desc).limit(n_last)
            .withColumn("pos", F.row_number().over(Window.orderBy(*desc))))
    small = total <= F.lit(limit)
    h = head.filter(small | (F.col("pos") <= n_first)).withColumn("part", F.lit("head"))
    t = tail.filter(~small).withColumn("part", F.lit("tail"))
    return h.unionByName(t).withColumn("total", total)
