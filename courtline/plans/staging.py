"""Staging models M1-M8: column selection and renames over the raw layer.

Each function takes the raw table and returns the staging view.  ``payload``
and ``ingested_at`` are carried through when the raw table has them (tables
from the ingest path do; fixture-derived tables do not).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.sources.tables import LazyTables

_TRAILER = ("payload", "ingested_at")


def _select(raw: DataFrame, cols: list[str | Column]) -> DataFrame:
    extra = [c for c in _TRAILER if c in raw.columns]
    return raw.select(*cols, *extra)


def stg_events(raw: DataFrame) -> DataFrame:
    return _select(raw, ["event_id", "code", "name", "start_date", "end_date", "type",
                         "no_parent_event", "country_code", "has_beach_tournament",
                         "has_men_tournament", "has_women_tournament", "is_vis_managed"])


def stg_tournaments(raw: DataFrame) -> DataFrame:
    return _select(raw, ["tournament_id", "name", "season", "tier", "start_date", "end_date",
                         "city", "country_code", "country_name", "gender", "status",
                         "timezone"])


def stg_teams(raw: DataFrame) -> DataFrame:
    return _select(raw, ["team_id", "tournament_id", "player_a_id", "player_b_id",
                         "country_code", "status", "valid_from", "valid_to"])


def height_inches(height_cm: Column) -> Column:
    """cm -> inches, rounded half-up to one decimal on the exact decimal quotient."""
    q = height_cm.cast("decimal(12,0)") / F.lit(2.54).cast("decimal(3,2)")
    return F.round(q, 1).cast("double")


def stg_players(raw: DataFrame) -> DataFrame:
    return _select(raw, ["player_id", "first_name", "last_name", "full_name", "gender",
                         "birth_date", height_inches(F.col("height_cm")).alias("height_inches"),
                         "country_code", "profile_url"])


def stg_matches(raw: DataFrame) -> DataFrame:
    return _select(raw, ["match_id", "tournament_id", "phase", F.col("round").alias("round_code"),
                         "team1_id", "team2_id", "winner_team_id", "score_sets",
                         "duration_minutes", "played_at", "result_type", "status"])


def stg_results(raw: DataFrame) -> DataFrame:
    return _select(raw, ["tournament_id", "team_id", "finishing_pos", "points", "prize_money"])


def stg_rounds(raw: DataFrame) -> DataFrame:
    return _select(raw, ["round_id", "tournament_id", "code", "name", "bracket", "phase",
                         "start_date", "end_date", "rank_method"])


def stg_team_rankings(raw: DataFrame) -> DataFrame:
    return _select(raw, ["ranking_type", "snapshot_date", "gender", "position", "no_player1",
                         "no_player2", "team_name", "earned_points"])


STAGING = {
    "events": stg_events, "tournaments": stg_tournaments, "teams": stg_teams,
    "players": stg_players, "matches": stg_matches, "results": stg_results,
    "rounds": stg_rounds, "team_rankings": stg_team_rankings,
}


def staging(raw: Mapping[str, DataFrame]) -> LazyTables:
    """All staging views over raw tables, each made when first asked for."""
    return LazyTables({name: (lambda fn=fn, name=name: fn(raw[name])) for name, fn in STAGING.items() if name in raw})
