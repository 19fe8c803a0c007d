"""Upsert semantics, incremental-ingest decisions and profiling."""

import datetime as d

from pyspark.sql import functions as F

from courtline.operators import quality as Q
from courtline.operators import upsert as U

T = "k long, seq long, v string, ingested_at timestamp"
B = "k long, seq long, v string"
def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, 1, "t1", None), (2, 2, "t2", None)], T)
    batch = spark.createDataFrame([(2, 5, "b2-old"), (2, 9, "b2-new"), (3, 4, "b3")], B)
    out = U.upsert(target, batch, ["k"], "seq", now())
    got = {r.k: r.v for r in out.collect()}
    assert got == {1: "t1", 2: "b2-new", 3: "b3"}
    assert out.filter(F.col("k") == 1).first().ingested_at is None
    # the same batch again changes nothing
    again = U.upsert(out, batch, ["k"], "seq", now())
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_phase_merge_priority(spark):
    df = lambda rows: spark.createDataFrame(rows, "t long, team long, pts int")
    out = U.phase_merge({"none": df([(1, 1, 1), (1, 2, 1)]), "MainDraw": df([(1, 1, 2)]),
                         "Qualification": df([(1, 1, 3), (1, 3, 3)])}, ["t", "team"])
    assert sorted((r.team, r.pts, r.phase) for r in out.collect()) == [
        (1, 3, "Qualification"), (2, 1, "none"), (3, 3, "Qualification")]


def test_skip_set_windows(spark):
    t = spark.createDataFrame([(1, d.date(2024, 12, 20)), (2, d.date(2024, 1, 1)), (3, None),
                               (4, d.date(2024, 12, 25))], "tournament_id long, start_date date")
    ts = lambda s: d.datetime.fromisoformat(s)
    res = spark.createDataFrame([(1, ts("2024-12-31 12:00:00")), (2, ts("2024-12-20 00:00:00")),
                                 (3, ts("2024-11-01 00:00:00")), (4, ts("2024-12-30 00:00:00"))],
                                "tournament_id long, ingested_at timestamp")
    rnd = res.limit(0)
    empty = spark.createDataFrame([(9, ts("2024-12-30 00:00:00"), ts("2024-12-30 00:00:00"))],
                                  "tournament_id long, results_empty_at timestamp, rounds_empty_at timestamp")
    got = sorted(r[0] for r in U.skip_set(t, res, rnd, empty, now()).collect())
    # 1: recent, within 24h; 2: older, within 30 days; 3: older, too old; 4: recent, not within 24h
    assert got == [1, 2, 9]


def test_tournament_year_and_expand(spark):
    t = spark.createDataFrame([(1, "2016", None, None), (2, "1995-96", d.date(2016, 1, 1), None),
                               (3, "x", None, d.date(2014, 5, 1)), (4, None, None, None),
                               (5, "2030", d.date(2030, 1, 1), None)],
                              "tournament_id long, season string, start_date date, end_date date")
    got = sorted(tuple(r) for r in U.expand_set(t, F.lit("2025-01-01").cast("date")).collect())
    assert got == [(1, 2016), (2, 2016), (4, None)]


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, 0.0, "a", d.date(2020, 1, 1)), (1, -0.0, None, None),
                                (None, 2.5, "b", d.date(2021, 1, 1))],
                               "i long, x double, s string, dt date")
    p = {r.column: r for r in Q.profile(df, "t").collect()}
    assert (p["i"].row_count, p["i"].null_count, p["i"].distinct_count) == (3, 1, 1)
    assert p["x"].distinct_count == 2           # -0.0 and 0.0 are one value
    assert (p["s"].min, p["s"].max, p["s"].null_proportion) == (None, None, 0.3333)
    assert (p["dt"].min, p["dt"].max) == ("2020-01-01", "2021-01-01")


def test_unique_tests(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 3)], "a long, b long")
    assert Q.unique(df, "a").count() == 1
    assert Q.unique_combination(df, ["a", "b"]).count() == 1


def test_typed_filter_categories(spark):
    from courtline.operators.preview import typed_filter
    df = spark.createDataFrame([(1, "Alpha", 5.0, d.date(2020, 1, 5), True),
                                (2, "beta", 50.0, d.date(2021, 1, 5), False),
                                (3, "ALPHABET", 7.0, d.date(2020, 2, 1), True)],
                               "id long, s string, x double, dt date, flag boolean")
    out = typed_filter(df, [("s", "alpha"), ("x", (1, 10)), ("dt", ("2020-01-01", "2020-12-31")),
                            ("flag", " TRUE "), ("id", "")], limit=10, order=["id"])
    assert [r.id for r in out.collect()] == [1, 3]
    assert [r.id for r in typed_filter(df, [], limit=2, order=["id"]).collect()] == [1, 2]


def test_head_tail_sample_small_and_large(spark):
    from courtline.operators.preview import head_tail_sample
    small = spark.range(4).withColumnRenamed("id", "k")
    got = sorted((r.k, r.part) for r in head_tail_sample(small, ["k"], 10).collect())
    assert got == [(0, "head"), (1, "head"), (2, "head"), (3, "head")]
    big = spark.range(100).withColumnRenamed("id", "k")
    rows = head_tail_sample(big, ["k"], 5).collect()
    assert sorted(r.k for r in rows) == [0, 1, 97, 98, 99] and {r.total for r in rows} == {100}


def test_rows_capped_floor_of_one(spark):
    from courtline.operators.preview import rows_capped
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "g long, o long")
    assert rows_capped(df, ["g"], ["o"], 0).count() == 2      # max(1, cap)


def test_profile_keeps_decimals_exact(spark):
    df = spark.sql("select * from values (12345678901234567.01BD), (12345678901234567.02BD), (null) as t(a)")
    p = {r.column: r for r in Q.profile(df, "t").collect()}
    assert (p["a"].distinct_count, p["a"].min, p["a"].max, p["a"].null_count) == (2, "12345678901234567.01", "12345678901234567.02", 1)
    wide = spark.sql("select cast(v as decimal(38, 0)) as w from values ('12345678901234567890123456789012345678'), ('12345678901234567890123456789012345679') as t(v)")
    r = Q.profile(wide, "t").first()
    assert (r.distinct_count, r.min, r.max) == (2, "12345678901234567890123456789012345678", "12345678901234567890123456789012345679")


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(20000).selectExpr("id as k", "id % 7 as v").write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    batch = spark.createDataFrame([(5, 100, 1), (5, 101, 2), (30000, 1, 1)], "k long, v long, seq long")
    out = U.upsert(target, batch.withColumn("v", F.col("v")), ["k"], "v", now())
    assert out.count() == 20001 and out.filter("k = 5").first().v == 101
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" not in plan


def test_profile_by_sketch_is_near_and_counts_stay_exact(spark):
    df = spark.range(20_000).selectExpr("id as a", "cast(id % 300 as string) as b", "if(id % 2 = 0, null, cast(id as double)) as `odd ``name`", "cast(null as decimal(30,25)) as d")
    exact = {r.column: r for r in Q.profile(df, "t").collect()}
    near = {r.column: r for r in Q.profile(df, "t", approximate=0.02).collect()}
    assert (exact["a"].distinct_count, exact["b"].distinct_count, exact["odd `name"].distinct_count, exact["d"].distinct_count) == (20_000, 300, 10_000, 0)
    for c, r in exact.items():
        assert abs(near[c].distinct_count - r.distinct_count) <= 0.08 * r.distinct_count
        assert near[c][:6] == r[:6] and near[c][7:] == r[7:]
    empty = Q.profile(df.limit(0), "t").collect()
    assert [(r.column, r.row_count, r.distinct_count, r.min) for r in empty] == [(c, 0, 0, None) for c in df.columns]
