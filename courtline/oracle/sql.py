"""Assembled oracle SQL, one statement per registered query."""

from __future__ import annotations

from courtline.oracle.league_sql import LG_CTES
from courtline.oracle.models_sql import CORE_CTES, MART_CTES, STAGING_CTES

_MODEL_CTES = ",".join([LG_CTES, STAGING_CTES, CORE_CTES, MART_CTES])

# Final SELECT of each query over the model CTEs.
_MODEL_SELECTS: dict[str, str] = {
    **{f"stg_{n}": f"select * from stg_{n}" for n in (
        "players", "matches", "tournaments", "teams", "rounds", "results", "team_rankings",
        "events")},
    "dim_tournaments": "select * from dim_tournaments",
    "dim_team_tournaments": "select * from dim_team_tournaments",
    "fct_team_rankings": "select * from fct_team_rankings",
    "fct_matches": "select * from fct_matches",
    "fct_matches_range": "select * from fct_matches",
    "fct_matches_buckets": "select * from fct_matches",
    "fct_tournament_standings": "select * from fct_tournament_standings",
    "match_mart": "select * from match_mart",
    "tournament_mart": "select * from tournament_mart",
    "champion_mart": "select * from champion_mart",
}


def model_sql(select: str, recursive: bool = False, extra_ctes: str = "") -> str:
    head = "with recursive " if recursive else "with "
    ctes = _MODEL_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"{head}{ctes}\n{select}"


def oracle_queries() -> dict[str, str]:
    from courtline.oracle.analytics_sql import ANALYTICS_SELECTS
    out = {name: model_sql(sel) for name, sel in {**_MODEL_SELECTS, **ANALYTICS_SELECTS}.items()}
    from courtline.oracle.elo_sql import ELO_CTES, ELO_SELECTS
    out.update({name: model_sql(sel, recursive=True, extra_ctes=ELO_CTES)
                for name, sel in ELO_SELECTS.items()})
    from courtline.oracle import extra_sql
    out.update(extra_sql.queries())
    return out
