"""Elo: the Spark pass against a plain sequential loop, plus invariants and edge rows."""

import datetime as d

import pytest
from pyspark.sql import functions as F

from courtline.league import League
from courtline.operators.elo import rate, round_weight
from courtline.plans.ratings import weighted_feed


def loop_elo(rows, k=32.0, start=1500.0):
    """Brute force: rows sorted by (pool, date, id); returns {(pid, match): (elo, elo_rw)}."""
    st, rw, out = {}, {}, {}
    for pool, mid, day, a1, a2, b1, b2, win, w in rows:
        if day is None:
            continue
        s, r = st.setdefault(pool, {}), rw.setdefault(pool, {})
        for state, kk in ((s, k), (r, k * w)):
            ta = (state.get(a1, start) + state.get(a2, start)) / 2.0
            tb = (state.get(b1, start) + state.get(b2, start)) / 2.0
            e = 1.0 / (1.0 + 10.0 ** ((tb - ta) / 400.0))
            dl = kk * ((1.0 if win else 0.0) - e)
            for p, sign in ((a1, 1), (a2, 1), (b1, -1), (b2, -1)):
                state[p] = state.get(p, start) + 0.5 * (sign * dl)
        for p in (a1, a2, b1, b2):
            out[(p, mid)] = (s[p], r[p])
    return out


@pytest.fixture(scope="module")
def feed(spark, small_dir):
    return weighted_feed(League.from_testdata(spark, small_dir).elo_match_feed)


def test_matches_sequential_loop(spark, feed):
    rows = sorted(tuple(r) for r in feed.select("gender", "match_id", "match_date", "a1", "a2", "b1", "b2",
                                               "is_winner_team1", "weight").collect())
    rows.sort(key=lambda r: (r[0], r[2] or d.date.min, r[1]))
    want = loop_elo(rows)
    got = {(r.player_id, r.match_id): (r.elo, r.elo_rw) for r in rate(feed).collect()}
    assert set(got) == set(want)
    bad = [k for k in want if abs(got[k][0] - want[k][0]) > 1e-9 or abs(got[k][1] - want[k][1]) > 1e-9]
    assert not bad


def test_history_is_four_rows_per_match_and_zero_sum(spark, feed):
    r = rate(feed)
    assert r.count() == 4 * feed.filter(F.col("match_date").isNotNull()).count()
    # expected scores of the two sides sum to one
    bad = (r.groupBy("match_id").agg(F.sum("expected").alias("s"))
           .filter(F.abs(F.col("s") - 2.0) > 1e-9).count())
    assert bad == 0


def test_edge_rows(spark):
    feed = spark.createDataFrame([
        ("M", 1, d.date(2020, 1, 1), 1, 1, 2, 3, True, 1.0),     # player listed twice
        ("M", 2, None, 1, 4, 2, 3, True, 1.0),                   # no date: skipped
        ("M", 3, d.date(2020, 1, 2), 1, 4, 2, 3, False, 2.0),    # winner is not team 1
    ], "gender string, match_id long, match_date date, a1 long, a2 long, b1 long, b2 long, "
       "is_winner_team1 boolean, weight double")
    got = {(r.player_id, r.match_id): r.elo for r in rate(feed).collect()}
    want = loop_elo([("M", 1, d.date(2020, 1, 1), 1, 1, 2, 3, True, 1.0),
                     ("M", 2, None, 1, 4, 2, 3, True, 1.0),
                     ("M", 3, d.date(2020, 1, 2), 1, 4, 2, 3, False, 2.0)])
    assert {k: v[0] for k, v in want.items()} == got
    assert got[(1, 1)] == 1516.0     # both halves of the team delta


def test_round_weight_order(spark):
    df = spark.createDataFrame([
        ("Semifinal", None, None, True), (None, "Final Four", False, None), ("x", "Quarterfinals", None, None),
        (None, "Round of 16", None, None), (None, "Pool A", None, True), ("", "", None, None),
        ("Gold", "x", True, True)], "phase string, name string, is_final boolean, is_pool boolean")
    got = [r[0] for r in df.select(round_weight(F.col("phase"), F.col("name"), F.col("is_final"),
                                                F.col("is_pool"))).collect()]
    assert got == [1.5, 1.5, 1.25, 1.1, 0.75, 1.0, 2.0]


def test_latest_wins_plus_losses(spark, small_dir):
    lt = League.from_testdata(spark, small_dir).elo_latest
    assert lt.filter(F.col("wins") + F.col("losses") != F.col("matches_played")).count() == 0


def test_component_pools_give_same_ratings(spark, feed):
    from courtline.operators.elo import component_pools
    by_gender = {(r.player_id, r.match_id): r.elo_rw for r in rate(feed).collect()}
    pooled = component_pools(feed)
    assert pooled.count() == feed.count()
    by_comp = {(r.player_id, r.match_id): r.elo_rw for r in rate(pooled, pool="pool").collect()}
    assert by_gender == by_comp


def test_connected_components(spark):
    from courtline.operators.graph import connected_components
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("d", "c")], "src string, dst string")
    got = {r.node: r.comp for r in connected_components(e).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}


def test_components_of_a_long_chain(spark):
    from courtline.operators.graph import connected_components
    e = spark.createDataFrame([(f"n{k:02d}", f"n{k + 1:02d}") for k in range(30)], "src string, dst string")
    assert {r.comp for r in connected_components(e).collect()} == {"n00"}


def test_long_feed_is_rated_in_stretches(spark, feed, tmp_path):
    """However long the feed, a walk sorts a stretch of it; the ratings are those of one walk."""
    whole = {(r.player_id, r.match_id): tuple(r) for r in rate(feed).collect()}
    cut = rate(feed, chunk_matches=-(-feed.count() // 3))
    files = {f.rsplit("/", 2)[1] for f in cut.inputFiles()}
    assert len(files) == 3
    got = {(r.player_id, r.match_id): tuple(r) for r in cut.collect()}
    assert got == whole and cut.count() == len(whole)


def test_component_pools_are_rated_in_stretches(spark):
    """A pool that does not play in every stretch goes on from its last ratings; no walk has more than its stretch."""
    from courtline.operators.elo import component_pools
    rows = [("M", k, d.date(2020, 1, 1) + d.timedelta(days=k), *((1, 3, 5, 7) if k < 4 or k > 15 else (2, 4, 6, 8)),
             k % 3 == 0, 1.5 if k % 2 else 1.0) for k in range(20)]
    feed = spark.createDataFrame(rows, "gender string, match_id long, match_date date, a1 long, a2 long, b1 long, "
                                       "b2 long, is_winner_team1 boolean, weight double")
    want = loop_elo([(r[0], *r[1:]) for r in rows])
    cut = rate(component_pools(feed), pool="pool", chunk_matches=4)
    got = {(r.player_id, r.match_id): (r.elo, r.elo_rw) for r in cut.collect()}
    assert got == want
    assert len({f.rsplit("/", 2)[1] for f in cut.inputFiles()}) == 5


def test_expected_scores_of_ratings_in_stretches(spark, small_dir):
    """Across the cuts each side is expected what the walk itself expected before the match."""
    from courtline.plans.ratings import expected_scores
    feed = League.from_testdata(spark, small_dir).elo_match_feed
    wf = weighted_feed(feed)
    want = {(r.player_id, r.gender, r.match_id): (r.expected, r.expected_rw) for r in rate(wf).collect()}
    cut = rate(wf, chunk_matches=-(-wf.count() // 3))
    got = {(r.player_id, r.gender, r.match_id): (r.expected_score, r.expected_score_rw)
           for r in expected_scores(feed, cut).collect()}
    assert len(cut.inputFiles()) > 1 and set(got) == set(want)
    assert all(abs(g - w) < 1e-6 for k in want for g, w in zip(got[k], want[k]))


def test_player_listed_twice_has_one_row(spark):
    feed = spark.createDataFrame([("M", 1, d.date(2020, 1, 1), 1, 1, 2, 1, True, 1.0)],
                                 "gender string, match_id long, match_date date, a1 long, a2 long, b1 long, b2 long, "
                                 "is_winner_team1 boolean, weight double")
    assert sorted(r.player_id for r in rate(feed).collect()) == [1, 2]


def test_no_walk_over_all_rows_of_a_player(spark, small_dir):
    """The latest row needs no sort of the history, and the rating before a match none of a player's whole timeline."""
    from courtline.operators.pairs import newest_by_date
    h = spark.createDataFrame([(1, "M", d.date(2020, 1, 1), 5, 1.0), (1, "M", d.date(2020, 1, 2), 3, 2.0),
                               (1, "M", d.date(2020, 1, 2), 4, 3.0), (1, None, d.date(2019, 1, 1), 9, 4.0)],
                              "player_id long, gender string, as_of_date date, match_id long, elo double")
    newest = newest_by_date(h, ["player_id", "gender"], "as_of_date", "match_id", ["elo"])
    assert sorted(map(tuple, newest.collect()), key=str) == [
        (1, "M", d.date(2020, 1, 2), 4, 3.0), (1, None, d.date(2019, 1, 1), 9, 4.0)]
    plan = newest._jdf.queryExecution().sparkPlan().toString()
    assert "Sort" not in plan and "ObjectHash" not in plan
    plan = League.from_testdata(spark, small_dir).elo_expected_score._jdf.queryExecution().optimizedPlan().toString()
    ordered = [line for line in plan.splitlines() if "lag(elo#" in line and "Window" in line]
    assert sum("_month" in line.rsplit("], [", 2)[-2] for line in ordered) == 1, ordered
