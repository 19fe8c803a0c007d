"""Oracle SQL for the ingest-side queries: expected values from the source columns."""

from courtline.oracle.sql import model_sql

_EXPAND = """
select tournament_id, year from (
  select tournament_id,
         cast(coalesce(case when regexp_full_match(trim(season), '[+-]?[0-9]+')
                             and try_cast(trim(season) as int) between 1900 and 2100
                            then try_cast(trim(season) as int) end,
                       year(start_date), year(end_date)) as int) as year,
         start_date
  from raw_tournaments) t
where (year is null or year >= 1998) and (start_date is null or start_date <= date '2001-09-01')"""

_CHECKS = """
select c.tournament_id,
       case when not exists (select 1 from raw_results r where r.tournament_id = c.tournament_id)
            then timestamp '2001-09-01 00:00:00' end as results_empty_at,
       case when not exists (select 1 from raw_rounds o where o.tournament_id = c.tournament_id)
            then timestamp '2001-09-01 00:00:00' end as rounds_empty_at
from (select distinct cast((year(l_shipdate) * 100 + month(l_shipdate)) * 10 + l_orderkey % 2 as bigint)
        as tournament_id from lineitem) c"""

INGEST_SQL = {
    "upsert_latest": """
with t as (select *, cast(ts as timestamp) as ingested_at from events where event_id % 2 = 0
           qualify row_number() over (partition by user_id order by event_id desc) = 1),
     b as (select *, timestamp '2024-12-31 00:00:00' as ingested_at from events where event_id % 2 = 1
           qualify row_number() over (partition by user_id order by event_id desc) = 1)
select event_id, ts, user_id, event_type, value, props, ingested_at from b
union all
select event_id, ts, user_id, event_type, value, props, ingested_at from t
where not exists (select 1 from b where b.user_id = t.user_id)""",
    "phase_merge": model_sql("""
, phased as (
  select tournament_id, team_id, finishing_pos, points, prize_money, 'none' as phase, 0 as prio from raw_results
  union all
  select tournament_id, team_id, finishing_pos, points + 1000, prize_money, 'MainDraw', 1 from raw_results
  where finishing_pos <= 8
  union all
  select tournament_id, team_id, finishing_pos, points + 2000, prize_money, 'Qualification', 2 from raw_results
  where finishing_pos > 4 and finishing_pos <= 12)
select tournament_id, team_id, finishing_pos, points, prize_money, phase from phased
qualify row_number() over (partition by tournament_id, team_id order by prio desc) = 1"""),
    "snapshot_stamp": model_sql("""
select * exclude (snapshot_date), snapshot_date as fetched_on, cast(snapshot_date + 1 as date) as snapshot_date from raw_team_rankings"""),
    "expand_set": model_sql(_EXPAND),
    "empty_checks": model_sql(_CHECKS),
    "ingest_skip_set": model_sql(f"""
, res as (select tournament_id,
                 cast(make_date(cast(tournament_id // 1000 as int), cast((tournament_id // 10) % 100 as int), 1)
                      + cast(team_id % 400 as int) as timestamp) as ingested_at from raw_results),
rnd as (select tournament_id, cast(start_date + cast(round_id % 500 as int) as timestamp) as ingested_at
        from raw_rounds),
last_ingest as (select tournament_id, max(ingested_at) as last_ingested
                from (select * from res union all select * from rnd) x group by tournament_id),
checks as ({_CHECKS}),
skip as (
  select i.tournament_id from last_ingest i join raw_tournaments t on t.tournament_id = i.tournament_id
  where (t.start_date >= date '2001-09-01' - interval 90 day
         and i.last_ingested >= timestamp '2001-09-01 00:00:00' - interval 24 hour)
     or (t.start_date is null or t.start_date < date '2001-09-01' - interval 90 day)
        and i.last_ingested >= timestamp '2001-09-01 00:00:00' - interval 30 day
  union
  select tournament_id from checks
  where results_empty_at is not null and rounds_empty_at is not null
    and results_empty_at >= timestamp '2001-09-01 00:00:00' - interval 30 day
    and rounds_empty_at >= timestamp '2001-09-01 00:00:00' - interval 30 day),
cand as ({_EXPAND})
select c.tournament_id, s.tournament_id is not null as skip, s.tournament_id is null as load
from cand c left join skip s on s.tournament_id = c.tournament_id"""),
    "source_filter": model_sql("""
select * from raw_tournaments where season in ('1997', '1998-99', '2001')"""),
    "source_filter_events": model_sql("""
select * from raw_events
where start_date >= date '2024-01-01' and end_date <= date '2024-01-31' and has_beach_tournament
  and coalesce(no_parent_event, 0) = 0"""),
    "rows_capped": """
select * from lineitem
qualify row_number() over (partition by l_orderkey
                           order by l_linenumber nulls first, l_partkey nulls first, l_suppkey nulls first,
                                    l_quantity nulls first, l_extendedprice nulls first, l_discount nulls first,
                                    l_tax nulls first, l_returnflag nulls first, l_linestatus nulls first,
                                    l_shipdate nulls first) <= 2""",
    "head_tail_sample": """
with o as (select o_orderkey, o_custkey, o_totalprice,
                  row_number() over (order by o_orderkey) as ra, row_number() over (order by o_orderkey desc) as rd,
                  count(*) over () as total
           from orders)
select o_orderkey, o_custkey, o_totalprice,
       case when total <= 10 or ra <= 5 then ra else rd end as pos,
       case when total <= 10 or ra <= 5 then 'head' else 'tail' end as part, total
from o where total <= 10 or ra <= 5 or rd <= 5""",
    "typed_filter_preview": """
select * from orders
where cast(o_orderpriority as varchar) ilike '%urgent%'
  and o_totalprice >= 1000 and o_totalprice <= 100000
  and cast(o_orderdate as date) >= date '1996-01-01' and cast(o_orderdate as date) <= date '1997-12-31'
order by o_orderkey limit 10000""",
    "parse_json_records": """
with ok as (select event_id, props from events
            where coalesce(event_type, '') <> 'error' and props is not null)
select event_id, 'K' as keys, cast(json_extract(props, '$.k') as bigint) as k, '{"k":' || json_extract_string(props, '$.k') || '}' as payload
from ok, range(if(event_id % 4 = 1, 2, 1))""",
    "parse_xml_records": """
select o_orderkey, o_orderkey as match_id, nullif(o_orderstatus, '') as status,
       'A & B <' || cast(o_custkey as varchar) || '>' as name, nullif(o_orderpriority, '') as priority,
       cast(null as varchar) as empty,
       '{"More":"m","Name":"A & B <' || o_custkey || '>","No":"' || o_orderkey || '","Other":"u","Priority":"' || o_orderpriority || '","Status":"' || o_orderstatus || '"}' as payload
from orders where o_orderkey % 5 <> 0""",
    "norm_match": model_sql("""
select match_id, tournament_id, cast(null as varchar) as phase, round, team1_id, team2_id,
       case when team2_id is null then null else winner_team_id end as winner_team_id,
       cast(case when winner_team_id = team1_id then 2 when winner_team_id = team2_id then 0 else 1 end as varchar)
         || '-' ||
       cast(case when winner_team_id = team1_id then 0 when winner_team_id = team2_id then 2 else 1 end as varchar)
         as score_sets,
       case when match_id % 900 + match_id % 700 <> 0
            then cast(floor((match_id % 900 + match_id % 700) / 60) as int) end as duration_minutes,
       played_at, cast(null as varchar) as result_type, cast(match_id % 3 as varchar) as status,
       cast(json_object('BeginDateTimeUtc', strftime(played_at, '%Y-%m-%d %H:%M:%S'), 'DurationSet1', match_id % 900,
         'DurationSet2', cast(match_id % 700 as varchar), 'DurationSet3', case when match_id % 4 = 0 then 'x' end,
         'MatchPointsA', case when winner_team_id = team1_id then 2 when winner_team_id = team2_id then 0 else 1 end,
         'MatchPointsB', cast(case when winner_team_id = team1_id then 0 when winner_team_id = team2_id then 2 else 1 end as varchar),
         'No', match_id, 'NoRound', if(match_id % 3 = 0, to_json(0), to_json('')), 'NoTeamA', team1_id,
         'NoTeamB', cast(team2_id as varchar), 'NoTournament', tournament_id, 'RoundCode', round, 'Status', match_id % 3) as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_matches"""),
    "norm_player": """
select c_custkey as player_id,
       case when c_custkey % 3 = 0 then null else 'F' || cast(c_custkey as varchar) end as first_name,
       c_mktsegment as last_name,
       case when c_custkey % 3 = 0 then c_mktsegment else 'F' || cast(c_custkey as varchar) || ' ' || c_mktsegment end
         as full_name,
       cast(c_custkey % 2 as varchar) as gender,
       make_date(cast(1950 + c_custkey % 50 as int), cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int))
         as birth_date,
       cast(case c_custkey % 4 when 0 then null when 1 then 100 + c_custkey when 2 then 150 + c_custkey % 60
                 else case when c_custkey % 900 < 500 then c_custkey % 900 end end as int) as height_cm,
       'N' || cast(c_nationkey as varchar) as country_code, cast(null as varchar) as profile_url,
       cast(json_object('Birthdate', (1950 + c_custkey % 50) || '-' || (1 + c_custkey % 12) || '-' || (1 + c_custkey % 28),
         'FederationCode', ' N' || c_nationkey || ' ', 'FirstName', if(c_custkey % 3 = 0, '', 'F' || c_custkey),
         'FullName', c_name, 'Gender', c_custkey % 2,
         'Height', case c_custkey % 4 when 0 then to_json('') when 1 then to_json(1000000 + c_custkey * 10000)
                   when 2 then to_json(150 + c_custkey % 60) else to_json(cast(c_custkey % 900 as varchar)) end,
         'LastName', c_mktsegment, 'No', if(c_custkey % 2 = 0, to_json(c_custkey), to_json(cast(c_custkey as varchar)))) as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from customer""",
    "norm_team": model_sql("""
select team_id, tournament_id, player_a_id, player_b_id, country_code, cast(team_id % 3 as varchar) as status,
       date '2001-01-05' as valid_from, cast(null as date) as valid_to,
       cast(json_object('CountryCode', country_code, 'No', cast(team_id as varchar), 'NoPlayer1', cast(player_a_id as varchar),
         'NoPlayer2', coalesce(cast(player_b_id as varchar), ''), 'NoTournament', cast(tournament_id as varchar),
         'Status', cast(team_id % 3 as varchar), 'ValidFrom', '2001-1-5') as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_teams"""),
    "export_csv_roundtrip": "select * from nation",
    "export_json_roundtrip": "select * from nation",
    "table_append": "select o_orderkey, o_custkey, o_totalprice from orders",
    "table_reload": "select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 2 = 1",
    "empty_checks_again": model_sql(f"""
, now_checked as ({_CHECKS})
select tournament_id, if(tournament_id % 2 = 0, results_empty_at, timestamp '2001-08-01 00:00:00') as results_empty_at,
       if(tournament_id % 2 = 0, rounds_empty_at, timestamp '2001-08-01 00:00:00') as rounds_empty_at
from now_checked"""),
    "norm_event": """
select event_id, upper(event_type) as code, cast(null as varchar) as name, cast(ts as date) as start_date,
       cast(null as date) as end_date, event_type as type, user_id % 3 as no_parent_event,
       cast(null as varchar) as country_code, event_id % 4 <> 3 as has_beach_tournament,
       true as has_men_tournament, false as has_women_tournament, false as is_vis_managed,
       cast(json_object('Code', upper(event_type), 'CountryCode', '', 'EndDate', null,
         'HasBeachTournament', case event_id % 4 when 0 then to_json('1') when 1 then to_json(true) when 2 then to_json('yes ') else to_json(0) end,
         'HasMenTournament', 'On', 'HasWomenTournament', null, 'IsVisManaged', 'false', 'Name', '', 'No', event_id,
         'NoParentEvent', user_id % 3, 'StartDate', strftime(ts, '%Y-%m-%d'), 'Type', event_type) as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from events""",
    "norm_tournament": model_sql("""
select tournament_id, case when m % 3 = 0 then 'C' || cast(m as varchar) else name end as name, season,
       cast(m as varchar) as tier, start_date, coalesce(end_date, start_date + 3) as end_date,
       case when m % 3 = 0 then 'C' || cast(m as varchar) end as city, country_code, country_name,
       cast(g as varchar) as gender, cast(null as varchar) as status, cast(null as varchar) as timezone,
       cast(json_object('CountryCode', country_code, 'CountryName', country_name, 'EndDateMainDraw', cast(end_date as varchar),
         'EndDateQualification', cast(start_date + 3 as varchar), 'Gender', g, 'Name', if(m % 3 = 0, 'C' || m, name),
         'No', tournament_id, 'Season', season, 'StartDate', cast(start_date as varchar), 'Timezone', '', 'Type', m) as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from lg_tournaments"""),
    "norm_result": model_sql("""
select tournament_id, team_id, finishing_pos, coalesce(points, 999) as points,
       coalesce(prize_money, 5.0) as prize_money, cast(json_object('EarnedPointsTeam', coalesce(cast(points as varchar), ''),
         'EarningsTotalTeam', coalesce(cast(cast(trunc(prize_money) as bigint) as varchar), ''), 'NoTeam', cast(team_id as varchar),
         'Points', '999', 'PrizeMoney', '5', 'Rank', cast(finishing_pos as varchar)) as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_results"""),
    "norm_round": model_sql("""
select round_id, tournament_id, code, name, bracket, phase, start_date, cast(null as date) as end_date,
       '<DirectElimination />' as rank_method, cast(case when bracket is null then json_object('Code', coalesce(code, ''), 'Name', coalesce(name, ''), 'No', cast(round_id as varchar),
           'NoTournament', cast(tournament_id as varchar), 'Phase', coalesce(phase, ''), 'RankMethod', '<DirectElimination />',
           'StartDate', coalesce(cast(start_date as varchar), ''))
         else json_object('Bracket', bracket, 'Code', coalesce(code, ''), 'Name', coalesce(name, ''), 'No', cast(round_id as varchar),
           'NoTournament', cast(tournament_id as varchar), 'Phase', coalesce(phase, ''), 'RankMethod', '<DirectElimination />',
           'StartDate', coalesce(cast(start_date as varchar), '')) end as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_rounds"""),
    "norm_round_ranking": model_sql("""
select tournament_id * 10 as round_id, finishing_pos as position,
       case when finishing_pos % 4 = 0 then -1 else finishing_pos end as rank,
       'N' || cast(team_id % 6 as varchar) as team_federation_code, cast(null as varchar) as team_name,
       points as match_points, 15 - finishing_pos as matches_won, finishing_pos - 1 as matches_lost,
       cast(json_object('MatchPoints', coalesce(cast(points as varchar), ''), 'MatchesLost', cast(finishing_pos - 1 as varchar),
         'MatchesWon', cast(15 - finishing_pos as varchar), 'Position', cast(finishing_pos as varchar),
         'Rank', cast(if(finishing_pos % 4 = 0, -1, finishing_pos) as varchar), 'TeamFederationCode', 'N' || (team_id % 6), 'TeamName', '') as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_results"""),
    "norm_team_ranking": model_sql("""
select ranking_type, snapshot_date, gender, position, no_player1, no_player2, cast(null as varchar) as team_name,
       earned_points, cast(json_object('EarnedPointsTeam', if(ranking_type = 'beach_world_tour', earned_points, 0), 'NoPlayer1', no_player1,
         'NoPlayer2', cast(no_player2 as varchar), 'Points', earned_points, 'Position', position, 'TeamName', '') as varchar) as payload,
       timestamp '2024-12-31 00:00:00' as ingested_at
from raw_team_rankings"""),
}
