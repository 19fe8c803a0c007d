"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the league fixture or
directly) over the whole table; none caps or samples its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtline.registry_store import league

Query = Callable[[SparkSession, str], DataFrame]


def _model(name: str, method: str = "fill") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(league(spark, sf_dir, method), name)
    run.__name__ = name
    return run


def _staging(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return league(spark, sf_dir).stg[name]
    run.__name__ = f"stg_{name}"
    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for n in ("players", "matches", "tournaments", "teams", "rounds", "results",
              "team_rankings", "events"):
        q[f"stg_{n}"] = _staging(n)
    for n in ("dim_tournaments", "dim_team_tournaments", "fct_team_rankings", "fct_matches",
              "fct_tournament_standings", "match_mart", "tournament_mart", "champion_mart",
              "elo_match_feed", "elo_round_weight", "elo_expected_score", "elo_history",
              "elo_history_round_weighted", "elo_latest", "elo_latest_round_weighted",
              "teams_list", "players_list", "perf_country_team_core", "perf_country_team",
              "perf_country_player", "perf_country_player_core", "perf_over_time", "perf_over_time_all",
              "elo_history_components", "player_pools"):
        q[n] = _model(n)
    q["fct_matches_range"] = _model("fct_matches", "range")
    q["fct_matches_buckets"] = _model("fct_matches", "buckets")
    from courtline import extra_queries
    q.update(extra_queries.registry())
    return q
