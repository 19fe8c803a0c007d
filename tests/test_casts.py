"""Safe casts on hand-made values (the loader's Python rules)."""

from pyspark.sql import functions as F

from courtline.functions import casts as C


def _eval(spark, json_values, fn):
    rows = [(f'{{"v": {j}}}',) for j in json_values]
    df = spark.createDataFrame(rows, "b string").select(
        F.try_variant_get(F.parse_json("b"), "$", "map<string,variant>")["v"].alias("v"))
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_safe_int(spark):
    vals = ['null', '""', '"  "', '" 7 "', '"12.5"', '"abc"', '12.5', '0', '"0"', '-3', 'true']
    assert _eval(spark, vals, C.safe_int) == [None, None, None, 7, None, None, 12, 0, 0, -3, 1]


def test_safe_int_absent_key(spark):
    df = spark.createDataFrame([('{"x": 1}',)], "b string").select(
        F.try_variant_get(F.parse_json("b"), "$", "map<string,variant>")["v"].alias("v"))
    assert df.select(C.safe_int(F.col("v"))).first()[0] is None


def test_safe_date(spark):
    vals = ['"2024-01-05T10:00"', '"2024-1-5"', '"2024"', '"2024-13-01"', '""', '20240105']
    import datetime as d
    assert _eval(spark, vals, C.safe_date) == [d.date(2024, 1, 5), d.date(2024, 1, 5), None, None,
                                               None, None]


def test_safe_bool(spark):
    vals = ['null', 'true', 'false', '"1"', '" Yes "', '"on"', '"0"', '1', '1.0', '"no"']
    assert _eval(spark, vals, C.safe_bool) == [False, True, False, True, True, True, False, True,
                                               False, False]


def test_truthy_and_fallback(spark):
    vals = ['0', '"0"', '""', 'null', '"PA"', '0.0', 'false', '5']
    assert _eval(spark, vals, C.truthy) == [False, True, False, False, True, False, False, True]
    # NoRound 0 falls through to RoundCode; '0' does not
    df = spark.createDataFrame([('{"a": 0, "b": "PA"}',), ('{"a": "0", "b": "PA"}',)], "j string")
    m = F.try_variant_get(F.parse_json("j"), "$", "map<string,variant>")
    got = [r[0] for r in df.select(C.text_if_present(C.first_truthy(m["a"], m["b"]))).collect()]
    assert got == ["PA", "0"]
