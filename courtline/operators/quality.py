"""Profiling and data-quality checks.

All checks are aggregations that return DataFrames; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.numeric import round_ratio

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)

PROFILE_COLUMNS = ["table", "column", "data_type", "row_count", "null_count",
                   "null_proportion", "distinct_count", "min", "max"]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _kind(c: str, dt: T.DataType) -> tuple[str, str]:
    """The type in which a column's distinct values are counted, and the column (SQL text) in it."""
    if isinstance(dt, _INTEGRAL):
        return "bigint", f"cast({c} as bigint)"
    if isinstance(dt, (T.BooleanType, *_FRACTIONAL, *_TEMPORAL)):
        return dt.simpleString(), c
    return "string", f"cast({c} as string)"


_FIGURES = ("row_count", "null_count", "min", "max", "distinct_count")


def _ends(df: DataFrame, no: int, approximate: float | None) -> DataFrame:
    """(no, pos, figures) of a table's columns but for exact distinct counts: one aggregation, one row.

    The expressions are SQL text: a table of many columns is one call to the JVM, not one for each operation.
    """
    aggs, rows = ["count(1) as n"], []
    for i, f in enumerate(df.schema.fields):
        c = _quoted(f.name)
        aggs.append(f"count({c}) as c{i}")
        lo = hi = "cast(null as string)"
        if isinstance(f.dataType, (*_INTEGRAL, *_FRACTIONAL, *_TEMPORAL)):
            aggs += [f"min({c}) as lo{i}", f"max({c}) as hi{i}"]
            lo, hi = (_shown(f"{end}{i}", f.dataType) for end in ("lo", "hi"))
        distinct = "cast(null as bigint)"
        if approximate is not None:
            aggs.append(f"approx_count_distinct({_kind(c, f.dataType)[1]}, {approximate}) as d{i}")
            distinct = f"d{i}"
        rows.append(f"struct({no} as no, {i} as pos, n as row_count, n - c{i} as null_count, {lo} as min, {hi} as max, {distinct} as distinct_count)")
    return df.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(rows)}))")


def _shown(c: str, dt: T.DataType) -> str:
    """SQL text: a least or greatest value as text; a decimal's digits without trailing zeros."""
    if isinstance(dt, T.DecimalType):
        return f"if(contains(cast({c} as string), '.'), rtrim('.', rtrim('0', cast({c} as string))), cast({c} as string))"
    return f"cast(cast({c} as double) as string)" if isinstance(dt, _FRACTIONAL) else f"cast({c} as string)"


def _distinct(tables: Sequence[DataFrame]) -> list[DataFrame]:
    """(no, pos, distinct_count) of all tables' columns, a DataFrame for each type."""
    by_kind: dict[str, DataFrame] = {}
    for no, df in enumerate(tables):
        own: dict[str, list[str]] = {}
        for i, f in enumerate(df.schema.fields):
            kind, c = _kind(_quoted(f.name), f.dataType)
            own.setdefault(kind, []).append(f"struct({no} as no, {i} as pos, {c} as v)")
        for kind, cells in own.items():
            x = df.selectExpr(f"inline(array({', '.join(cells)}))").filter("v is not null")
            by_kind[kind] = by_kind[kind].unionByName(x) if kind in by_kind else x
    return [x.distinct().groupBy("no", "pos").agg(F.count(F.lit(1)).alias("distinct_count")) for x in by_kind.values()]


def profile_tables(tables: Mapping[str, DataFrame], approximate: float | None = None) -> DataFrame:
    """Per column of each table: rows, nulls, null share (4 dp), distinct values, min/max (numbers, dates, times).

    Counts and ends are one aggregation a table with partial sums: nothing but a
    row a task is shuffled.  Distinct values are counted exactly by unpivoting
    the columns of one type, of all tables, to (column, value) in that type: equal values
    leave a task once, so neither a hot value nor a column of many values lands
    in one task.  ``approximate``: a relative standard deviation; distinct
    values are then estimated by a sketch (HyperLogLog++) in the first
    aggregation and no value is shuffled.
    """
    spark = next(iter(tables.values())).sparkSession
    names = sorted(tables)
    parts = [_ends(tables[n], no, approximate) for no, n in enumerate(names)]
    if approximate is None:
        parts += _distinct([tables[n] for n in names])
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    one = union.groupBy("no", "pos").agg(*[F.max(c).alias(c) for c in _FIGURES])
    about = spark.createDataFrame([(no, i, n, f.name, f.dataType.simpleString()) for no, n in enumerate(names) for i, f in enumerate(tables[n].schema.fields)],
                                  "no int, pos int, table string, column string, data_type string")
    return about.join(one, ["no", "pos"]).orderBy("no", "pos").select(
        "table", "column", "data_type", "row_count", "null_count",
        round_ratio(F.col("null_count"), F.col("row_count"), 4).alias("null_proportion"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"), "min", "max")


def profile(df: DataFrame, table: str, approximate: float | None = None) -> DataFrame:
    """:func:`profile_tables` of one table."""
    return profile_tables({table: df}, approximate)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<col>_min`` / ``<col>_max`` per column; date-times reported as dates."""
    aggs = []
    for c in columns:
        dt = df.schema[c].dataType
        v = F.to_date(c) if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else (
            F.col(c).cast("double") if isinstance(dt, _INTEGRAL + _FRACTIONAL) else F.col(c))
        aggs += [F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
    return df.agg(*aggs)


def unique(df: DataFrame, column: str) -> DataFrame:
    """``unique`` test: non-NULL values present more than once (empty = pass)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``unique_combination_of_columns`` test: combinations present more than once."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def at_least_one(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """``at_least_one`` test: one row with the non-NULL count and the verdict."""
    return df.agg(F.count(F.col(column)).alias("non_null")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column"), "non_null",
        (F.col("non_null") > 0).alias("passed"))


def row_counts(tables: Mapping[str, DataFrame], label: str = "table") -> DataFrame:
    """Labelled row counts as one DataFrame (union of global aggregates)."""
    out = None
    for i, (name, df) in enumerate(tables.items()):
        c = df.agg(F.count(F.lit(1)).alias("cnt")).select(
            F.lit(i).alias("_ord"), F.lit(name).alias(label), "cnt")
        out = c if out is None else out.unionByName(c)
    return out.orderBy("_ord").drop("_ord")


def nonempty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fail-if-empty check of core tables: (table, cnt, ok)."""
    return row_counts(tables).withColumn("ok", F.col("cnt") > 0)


def test_summary(tests: Sequence[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """(model, test, columns, failures): failing-row count of each test result."""
    out = None
    for i, (model, test, cols, res) in enumerate(tests):
        c = res.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(i).alias("_ord"), F.lit(model).alias("model"), F.lit(test).alias("test"),
            F.lit(cols).alias("columns"), "failures")
        out = c if out is None else out.unionByName(c)
    return out.orderBy("_ord").drop("_ord")
