"""Oracle SQL for profiling, data-quality and ingest queries."""

from __future__ import annotations

from courtline.oracle.sql import model_sql

# Column catalogue of the raw layer (name and type letter: l bigint, i int, f double, s string, d date, t timestamp, b boolean).
_TYPES = {"l": "bigint", "i": "int", "f": "double", "s": "string", "d": "date", "t": "timestamp", "b": "boolean"}
_COLUMNS = {
    "raw_players": "player_id:l first_name:s last_name:s full_name:s gender:s birth_date:d height_cm:i country_code:s profile_url:s",
    "raw_tournaments": "tournament_id:l name:s season:s tier:s start_date:d end_date:d city:s country_code:s country_name:s gender:s status:s timezone:s",
    "raw_teams": "team_id:l tournament_id:l player_a_id:l player_b_id:l country_code:s status:s valid_from:d valid_to:d",
    "raw_matches": "match_id:l tournament_id:l phase:s round:s team1_id:l team2_id:l winner_team_id:l score_sets:s duration_minutes:i played_at:t result_type:s status:s",
    "raw_results": "tournament_id:l team_id:l finishing_pos:i points:i prize_money:f",
    "raw_rounds": "round_id:l tournament_id:l code:s name:s bracket:s phase:s start_date:d end_date:d rank_method:s",
    "raw_team_rankings": "ranking_type:s snapshot_date:d gender:s position:i no_player1:l no_player2:l team_name:s earned_points:i",
    "raw_events": "event_id:l code:s name:s start_date:d end_date:d type:s no_parent_event:l country_code:s has_beach_tournament:b has_men_tournament:b has_women_tournament:b is_vis_managed:b",
}
PROFILE_SCHEMAS = {t: [(c.split(":")[0], _TYPES[c[-1]]) for c in cols.split()] for t, cols in _COLUMNS.items()}
_ORDERED = {"bigint", "int", "double", "timestamp", "date"}


def _profile_sql() -> str:
    parts = []
    for table in sorted(PROFILE_SCHEMAS):
        for col, typ in PROFILE_SCHEMAS[table]:
            lo = f"cast(min({col}) as varchar)" if typ in _ORDERED else "cast(null as varchar)"
            hi = f"cast(max({col}) as varchar)" if typ in _ORDERED else "cast(null as varchar)"
            parts.append(
                f"select '{table}' as \"table\", '{col}' as \"column\", '{typ}' as data_type, "
                f"count(*) as row_count, count(*) - count({col}) as null_count, "
                f"case when count(*) > 0 then ((count(*) - count({col})) * 20000 + count(*)) // "
                f"(2 * count(*)) / 10000.0 end as null_proportion, "
                f"count(distinct {col}) as distinct_count, {lo} as \"min\", {hi} as \"max\" "
                f"from {table}")
    return "\nunion all\n".join(parts)


_AT_LEAST_ONE = [("dim_tournaments", "tournament_id"), ("dim_team_tournaments", "team_id"),
                 ("fct_matches", "match_id"), ("fct_tournament_standings", "tournament_id"),
                 ("fct_team_rankings", "ranking_type"), ("match_mart", "match_id"),
                 ("tournament_mart", "tournament_id"), ("champion_mart", "tournament_id")]


def _at_least_one_sql() -> str:
    return "\nunion all\n".join(
        f"select '{m}' as model, '{c}' as \"column\", count({c}) as non_null, count({c}) > 0 as passed "
        f"from {m}" for m, c in _AT_LEAST_ONE)


def _schema_tests_sql() -> str:
    rows = []
    for m, c in [("stg_events", "event_id"), ("stg_tournaments", "tournament_id"),
                 ("stg_teams", "team_id"), ("stg_players", "player_id"),
                 ("stg_matches", "match_id"), ("stg_rounds", "round_id")]:
        rows.append(f"select '{m}' as model, 'unique' as test, '{c}' as columns, count(*) as failures "
                    f"from (select {c} from {m} where {c} is not null group by {c} having count(*) > 1) x")
    for m, cs in [("stg_results", "tournament_id,team_id"),
                  ("stg_team_rankings", "ranking_type,snapshot_date,gender,position")]:
        rows.append(f"select '{m}' as model, 'unique_combination_of_columns' as test, '{cs}' as columns, "
                    f"count(*) as failures from (select {cs} from {m} group by {cs} having count(*) > 1) x")
    for m, c in _AT_LEAST_ONE:
        rows.append(f"select '{m}' as model, 'at_least_one' as test, '{c}' as columns, "
                    f"case when count({c}) = 0 then 1 else 0 end as failures from {m}")
    return "\nunion all\n".join(f"select * from ({r})" for r in rows)


def queries() -> dict[str, str]:
    from courtline.oracle.elo_sql import ELO_CTES
    out = {
        "column_profile": model_sql(_profile_sql()),
        "minmax_profile": """
select cast(min(o_orderkey) as double) as o_orderkey_min, cast(max(o_orderkey) as double) as o_orderkey_max,
       cast(min(o_custkey) as double) as o_custkey_min, cast(max(o_custkey) as double) as o_custkey_max,
       min(o_orderstatus) as o_orderstatus_min, max(o_orderstatus) as o_orderstatus_max,
       min(o_orderpriority) as o_orderpriority_min, max(o_orderpriority) as o_orderpriority_max,
       min(o_totalprice) as o_totalprice_min, max(o_totalprice) as o_totalprice_max,
       cast(min(o_orderdate) as date) as o_orderdate_min, cast(max(o_orderdate) as date) as o_orderdate_max
from orders""",
        "dq_unique": """
select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null
group by l_orderkey having count(*) > 1""",
        "dq_unique_combo": """
select l_orderkey, l_linenumber, count(*) as n_records from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
        "dq_at_least_one": model_sql(_at_least_one_sql()),
        "dq_schema_tests": model_sql(_schema_tests_sql()),
        "core_nonempty": model_sql("""
select 'raw_tournaments' as "table", count(*) as cnt, count(*) > 0 as ok from raw_tournaments
union all select 'raw_teams', count(*), count(*) > 0 from raw_teams
union all select 'raw_matches', count(*), count(*) > 0 from raw_matches"""),
        "pipeline_funnel": model_sql("""
select 'raw_matches' as stage, count(*) as cnt from raw_matches
union all select 'raw with winner', count(*) from raw_matches where winner_team_id is not null
union all select 'elo_match_feed', count(*) from elo_match_feed
union all select 'feed with played_at', count(*) from elo_match_feed where played_at is not null
union all select 'feed with played_at or start_date', count(*) from elo_match_feed
  where played_at is not null or tournament_start_date is not null
union all select 'player_elo_history', count(*) from elo_hist_std""", recursive=True, extra_ctes=ELO_CTES),
        "distinct_player_ids": model_sql("""
select distinct id from (select player_a_id as id from raw_teams where player_a_id is not null
                         union select player_b_id from raw_teams where player_b_id is not null) u"""),
    }
    from courtline.oracle.ingest_sql import INGEST_SQL
    out.update(INGEST_SQL)
    from courtline.oracle.upkeep_sql import UPKEEP_SQL
    out.update(UPKEEP_SQL)
    return out
