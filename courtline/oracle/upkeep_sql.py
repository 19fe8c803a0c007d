"""Oracle SQL of the queries over stored state: what a full computation gives."""

from courtline.oracle.ingest_sql import _EXPAND
from courtline.oracle.sql import model_sql

_NEWEST = """
select event_id, ts, user_id, event_type, value, props, {at} as ingested_at
from (select *, case event_id % 4 when 1 then 2 when 3 then 3 else 1 end as load from events) e
where load <= {loads}
qualify row_number() over (partition by user_id order by load desc, event_id desc) = 1"""

_STATE = """
, ids as (select distinct cast((year(l_shipdate) * 100 + month(l_shipdate)) * 10 + l_orderkey % 2 as bigint) as tournament_id from lineitem),
res as (select tournament_id, team_id,
               cast(make_date(cast(tournament_id // 1000 as int), cast((tournament_id // 10) % 100 as int), 1)
                    + cast(team_id % 400 as int) as timestamp) as ingested_at from raw_results),
rnd as (select tournament_id, round_id, cast(start_date + cast(round_id % 500 as int) as timestamp) as ingested_at from raw_rounds),
checks as (select tournament_id, tournament_id // 10 % 3 as k, timestamp '2001-09-01 00:00:00' + to_days(cast(tournament_id // 10 % 3 - 2 as int)) as at from ids),
fresh as (
  select t.tournament_id,
         (select max(ingested_at) from (select tournament_id, ingested_at from res union all select tournament_id, ingested_at from rnd) x where x.tournament_id = t.tournament_id) as last_ingested,
         exists (select 1 from res r where r.tournament_id = t.tournament_id) as has_results,
         exists (select 1 from rnd o where o.tournament_id = t.tournament_id) as has_rounds,
         case when not exists (select 1 from res r where r.tournament_id = t.tournament_id and r.team_id % 3 <= c.k) then c.at end as results_empty_at,
         case when not exists (select 1 from rnd o where o.tournament_id = t.tournament_id and o.round_id % 3 <= c.k) then c.at end as rounds_empty_at
  from (select tournament_id from res union select tournament_id from rnd union select tournament_id from ids) t
  left join checks c on c.tournament_id = t.tournament_id)"""

_SKIP = f"""
, skip as (
  select f.tournament_id from fresh f join raw_tournaments t on t.tournament_id = f.tournament_id
  where (t.start_date >= date '2001-09-01' - 90 and f.last_ingested >= timestamp '2001-09-01 00:00:00' - interval 24 hour)
     or ((t.start_date is null or t.start_date < date '2001-09-01' - 90) and f.last_ingested >= timestamp '2001-09-01 00:00:00' - interval 30 day)
  union
  select tournament_id from fresh where results_empty_at >= timestamp '2001-09-01 00:00:00' - interval 30 day and rounds_empty_at >= timestamp '2001-09-01 00:00:00' - interval 30 day)
select c.tournament_id, s.tournament_id is not null as skip from ({_EXPAND}) c left join skip s on s.tournament_id = c.tournament_id"""

UPKEEP_SQL = {
    "upgraded_tournaments": model_sql("""
select *, cast(null as varchar) as payload, timestamp '2024-12-31 00:00:00' as ingested_at from raw_tournaments where regexp_full_match(season, '[0-9]+')"""),
    "upgraded_matches": model_sql("select *, cast(null as varchar) as payload, cast(null as timestamp) as ingested_at from raw_matches"),
    "stored_upsert": _NEWEST.format(at="timestamp '2001-09-01 00:00:00' + to_days(load)", loads=3),
    "stored_upsert_keys": f"""
select * from ({_NEWEST.format(at="timestamp '2024-12-31 00:00:00'", loads=2)}) x where user_id in (select user_id from events where event_type = 'purchase')""",
    "freshness_state": model_sql(_STATE + " select * from fresh"),
    "ingest_skip_from_state": model_sql(_STATE + _SKIP),
    **{f"refreshed_{m}": model_sql(f"select * from {m}") for m in ("fct_matches", "fct_tournament_standings", "match_mart", "tournament_mart", "champion_mart")},
}
