"""Queries beyond the model views: profiling, data quality, ingest operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.registry_store import league
from courtline.operators import quality as q
from courtline.sources.tables import read_table

# Declared schema tests of the models (fixed list).
UNIQUE_TESTS = [("stg_events", "events", "event_id"),
                ("stg_tournaments", "tournaments", "tournament_id"),
                ("stg_teams", "teams", "team_id"), ("stg_players", "players", "player_id"),
                ("stg_matches", "matches", "match_id"), ("stg_rounds", "rounds", "round_id")]
COMBO_TESTS = [("stg_results", "results", ["tournament_id", "team_id"]),
               ("stg_team_rankings", "team_rankings",
                ["ranking_type", "snapshot_date", "gender", "position"])]
AT_LEAST_ONE_TESTS = [("dim_tournaments", "tournament_id"), ("dim_team_tournaments", "team_id"),
                      ("fct_matches", "match_id"), ("fct_tournament_standings", "tournament_id"),
                      ("fct_team_rankings", "ranking_type"), ("match_mart", "match_id"),
                      ("tournament_mart", "tournament_id"), ("champion_mart", "tournament_id")]


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table of the raw layer."""
    return q.profile_tables({f"raw_{n}": t for n, t in league(spark, sf_dir).raw.items()})


def minmax_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.min_max(read_table(spark, sf_dir, "orders"),
                     ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unique(read_table(spark, sf_dir, "lineitem"), "l_orderkey")


def dq_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unique_combination(read_table(spark, sf_dir, "lineitem"),
                                ["l_orderkey", "l_linenumber"])


def dq_at_least_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    out = None
    for model, col in AT_LEAST_ONE_TESTS:
        r = q.at_least_one(getattr(lg, model), col, model)
        out = r if out is None else out.unionByName(r)
    return out


def dq_schema_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    tests = [(m, "unique", c, q.unique(lg.stg[t], c)) for m, t, c in UNIQUE_TESTS]
    tests += [(m, "unique_combination_of_columns", ",".join(cs), q.unique_combination(lg.stg[t], cs))
              for m, t, cs in COMBO_TESTS]
    tests += [(m, "at_least_one", c, q.at_least_one(getattr(lg, m), c, m).filter(~F.col("passed")))
              for m, c in AT_LEAST_ONE_TESTS]
    return q.test_summary(tests)


def core_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    return q.nonempty({f"raw_{t}": lg.raw[t] for t in ("tournaments", "teams", "matches")})


def _rated(feed: DataFrame) -> DataFrame:
    """What the rating history has a row for: each player of each dated match, once."""
    players = F.explode(F.array(*[F.col(f"team{n}_player_{p}_id") for n in (1, 2) for p in "ab"]))
    return (feed.filter(F.col("match_date").isNotNull())
            .select("match_id", "tournament_gender", players.alias("player_id")).distinct())


def pipeline_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    m, feed = lg.raw["matches"], lg.elo_match_feed
    return q.row_counts({
        "raw_matches": m,
        "raw with winner": m.filter(F.col("winner_team_id").isNotNull()),
        "elo_match_feed": feed,
        "feed with played_at": feed.filter(F.col("played_at").isNotNull()),
        "feed with played_at or start_date": feed.filter(
            F.col("played_at").isNotNull() | F.col("tournament_start_date").isNotNull()),
        "player_elo_history": _rated(feed),
    }, label="stage")


def distinct_player_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = league(spark, sf_dir).raw["teams"]
    a = t.select(F.col("player_a_id").alias("id")).filter(F.col("id").isNotNull())
    b = t.select(F.col("player_b_id").alias("id")).filter(F.col("id").isNotNull())
    return a.union(b).distinct().orderBy("id")


def registry() -> dict:
    out = {f.__name__: f for f in (
        column_profile, minmax_profile, dq_unique, dq_unique_combo, dq_at_least_one,
        dq_schema_tests, core_nonempty, pipeline_funnel, distinct_player_ids)}
    from courtline import ingest_queries
    out.update(ingest_queries.registry())
    from courtline import upkeep_queries
    out.update(upkeep_queries.registry())
    return out
