"""League fixture tables as DuckDB CTEs (FIXTURES.md part B) plus raw-layer columns."""

LG_CTES = r"""
lg_players as (
  select case when c_custkey = 40 then -41 else c_custkey + 1 end as player_id, c_name as full_name, n_name as country_code,
         case when c_custkey % 2 = 0 then 'M' else 'W' end as gender,
         case when c_custkey % 11 = 0 then null else cast(160 + c_custkey % 50 as int) end as height_cm
  from customer join nation on n_nationkey = c_nationkey),
lg_base as (
  select o_orderkey as match_id, cast(o_orderdate as date) as d, o_orderstatus as st, o_custkey % 2 as g,
         (year(o_orderdate) * 100 + month(o_orderdate)) * 10 + o_custkey % 2 as tournament_id,
         cast(floor(o_custkey / 2) as bigint) % 16 as i1,
         (cast(floor(o_custkey / 2) as bigint) % 16 + 1 + o_orderkey % 15) % 16 as i2
  from orders),
lg_tournaments as (
  select tournament_id, concat('Open ', cast(m as varchar)) as name,
         case when y % 2 = 0 then concat(cast(y as varchar), '-', cast((y + 1) % 100 as varchar)) else cast(y as varchar) end as season,
         case when m = 6 then 'World Championship' when m = 8 then 'Olympic Games' else 'Open' end as tier,
         make_date(cast(y as int), cast(m as int), 1) as start_date,
         case when m = 3 then null else make_date(cast(y as int), cast(m as int), 27) end as end_date,
         concat('C', cast(m % 5 as varchar)) as country_code,
         case when m = 2 then null else concat('Country ', cast(m % 5 as varchar)) end as country_name,
         case when g = 0 then 'M' else 'W' end as gender, y, m, g
  from (select distinct tournament_id, g, cast(floor(tournament_id / 1000) as bigint) as y,
               cast(floor(tournament_id / 10) as bigint) % 100 as m from lg_base) t),
lg_teams as (
  select tournament_id * 100 + i as team_id, tournament_id,
         4 * i + g + 1 as player_a_id,
         case when i = 14 then null else 4 * ((i + y % 3) % 16) + 2 + g + 1 end as player_b_id,
         concat('N', cast(i % 6 as varchar)) as country_code, i, y, g
  from lg_tournaments cross join (select cast(n_nationkey as bigint) as i from nation where n_nationkey < 16) k),
lg_rounds as (
  select tournament_id * 10 + k as round_id, tournament_id,
         case k when 0 then 'PA' when 1 then 'QF' when 2 then 'SF' else 'F' end as code,
         case k when 0 then 'Pool A' when 1 then 'Quarterfinals' when 2 then 'Semifinals' else 'Final' end as name,
         case k when 0 then 'Pool' when 1 then null else 'W' end as bracket,
         case k when 0 then null when 1 then 'Bracket' when 2 then 'Bracket' else 'Final' end as phase,
         make_date(cast(y as int), cast(m as int), cast(case k when 0 then 1 when 1 then 11 when 2 then 21 else 27 end as int)) as start_date
  from lg_tournaments cross join (select cast(n_nationkey as bigint) as k from nation where n_nationkey < 4) r
  where not (k = 2 and m = 4)),
lg_matches as (
  select match_id, tournament_id, cast(null as varchar) as phase,
         case when day(d) <= 10 then 'PA' when day(d) <= 20 then 'QF' when day(d) <= 26 then 'SF' else 'F' end as round,
         tournament_id * 100 + i1 as team1_id,
         case when match_id % 97 = 0 then null else tournament_id * 100 + i2 end as team2_id,
         case st when 'F' then tournament_id * 100 + i1 when 'O' then tournament_id * 100 + i2 end as winner_team_id,
         case when match_id % 5 = 0 then cast(d as timestamp) end as played_at
  from lg_base),
lg_results as (
  select tournament_id, team_id, finishing_pos,
         case when finishing_pos % 7 = 0 then null else 1600 - 100 * finishing_pos end as points,
         case when finishing_pos % 5 = 0 then null else 20000 - 1000 * finishing_pos end as prize_money
  from (select t.tournament_id, t.team_id,
               cast(row_number() over (partition by t.tournament_id order by coalesce(w.wins, 0) desc, t.team_id) as int) as finishing_pos
        from lg_teams t left join (select winner_team_id, count(*) as wins from lg_matches
                                   where winner_team_id is not null group by winner_team_id) w on w.winner_team_id = t.team_id
        where t.i <> 15) z),
lg_rankings as (
  select rt as ranking_type, make_date(cast(y as int), cast(q * 3 - 2 as int), 15) as snapshot_date,
         case when g = 0 then 'M' else 'W' end as gender,
         cast((i * 7 + q * 3 + y + off) % 16 + 1 as int) as position,
         case when i % 2 = 0 then pa else pb end as no_player1, case when i % 2 = 0 then pb else pa end as no_player2,
         cast((16 - (i * 7 + q * 3 + y + off) % 16) * 50 as int) as earned_points
  from (select y, q, g, i, 4 * i + g + 1 as pa, 4 * ((i + y % 3) % 16) + 2 + g + 1 as pb
        from (select distinct y, cast(floor((m + 2) / 3) as bigint) as q, g from lg_tournaments) p
        cross join (select cast(n_nationkey as bigint) as i from nation where n_nationkey < 15) k) s
  cross join (select 'beach_world_tour' as rt, 0 as off union all select 'beach_olympic' as rt, 5 as off) f),
raw_players as (
  select cast(player_id as bigint) as player_id, cast(null as varchar) as first_name, cast(null as varchar) as last_name,
         full_name, gender, cast(null as date) as birth_date, height_cm, country_code, cast(null as varchar) as profile_url
  from lg_players),
raw_tournaments as (
  select cast(tournament_id as bigint) as tournament_id, name, season, tier, start_date, end_date,
         cast(null as varchar) as city, country_code, country_name, gender,
         cast(null as varchar) as status, 'UTC' as timezone
  from lg_tournaments),
raw_teams as (
  select cast(team_id as bigint) as team_id, cast(tournament_id as bigint) as tournament_id,
         cast(player_a_id as bigint) as player_a_id, cast(player_b_id as bigint) as player_b_id, country_code,
         cast(null as varchar) as status, cast(null as date) as valid_from, cast(null as date) as valid_to
  from lg_teams),
raw_matches as (
  select cast(match_id as bigint) as match_id, cast(tournament_id as bigint) as tournament_id, phase, round,
         cast(team1_id as bigint) as team1_id, cast(team2_id as bigint) as team2_id,
         cast(winner_team_id as bigint) as winner_team_id,
         case when winner_team_id = team1_id then '2-0' when winner_team_id = team2_id then '0-2' end as score_sets,
         cast(30 + match_id % 31 as int) as duration_minutes,
         played_at, cast(null as varchar) as result_type, cast(null as varchar) as status
  from lg_matches),
raw_results as (
  select cast(tournament_id as bigint) as tournament_id, cast(team_id as bigint) as team_id, finishing_pos,
         cast(points as int) as points, cast(prize_money as double) as prize_money
  from lg_results),
raw_rounds as (
  select cast(round_id as bigint) as round_id, cast(tournament_id as bigint) as tournament_id, code, name, bracket, phase,
         start_date, cast(null as date) as end_date, cast(null as varchar) as rank_method
  from lg_rounds),
raw_team_rankings as (
  select ranking_type, snapshot_date, gender, position, cast(no_player1 as bigint) as no_player1,
         cast(no_player2 as bigint) as no_player2, cast(null as varchar) as team_name, earned_points
  from lg_rankings),
raw_events as (
  select event_id, upper(event_type) as code, concat('Event ', cast(event_id as varchar)) as name,
         cast(ts as date) as start_date, cast(cast(ts as date) + cast(user_id % 5 as int) as date) as end_date,
         event_type as type, cast(null as bigint) as no_parent_event,
         concat('N', cast(user_id % 6 as varchar)) as country_code,
         value > 10 as has_beach_tournament, user_id % 2 = 0 as has_men_tournament,
         user_id % 2 = 1 as has_women_tournament, event_type = 'view' as is_vis_managed
  from events)
"""
