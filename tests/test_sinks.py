"""Sinks: append (S6), full reload (S7), CSV / JSON export."""

from courtline.operators.upsert import append
from courtline.sources.sinks import csv_roundtrip, export_json, scratch_path, write_table


def test_write_append_reload(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(2, "y")], "k long, v string")
    path = scratch_path(a, "sink-test")
    write_table(a, path)
    write_table(b, path, mode="append")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    write_table(b, path)                       # full reload replaces everything
    assert [r.k for r in spark.read.parquet(path).collect()] == [2]
    assert append(a, b).count() == 2


def test_exports(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k long, v string")
    assert sorted(map(tuple, csv_roundtrip(df, "t").collect()), key=lambda r: r[0]) == [(1, "a,b"), (2, None)]
    path = export_json(df, name="t")
    back = spark.read.schema(df.schema).json(path)
    assert sorted(r.k for r in back.collect()) == [1, 2]
