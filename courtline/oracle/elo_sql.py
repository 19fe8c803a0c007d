"""Elo oracle (DuckDB): the rating loop as a recursive CTE, and the marts over it.

Valid on the league fixture only: player ids are 1..64 with odd ids male and
even ids female, so ``(id + 1) // 2`` indexes a 32-slot state per gender, and
no player is on both sides of one match.
"""

ELO_CTES = r"""
elo_match_feed as (
  select distinct on (match_id) match_id, match_date, played_at, d.start_date as tournament_start_date, m.tournament_gender,
         x.player_a_id as team1_player_a_id, x.player_b_id as team1_player_b_id, y.player_a_id as team2_player_a_id, y.player_b_id as team2_player_b_id,
         is_winner_team1, round_phase, round_name, is_final, is_pool_phase
  from fct_matches m join dim_tournaments d using (tournament_id)
  join teams_keyed x on (x.team_id, x.tournament_id) = (m.team1_id, m.tournament_id)
  join teams_keyed y on (y.team_id, y.tournament_id) = (m.team2_id, m.tournament_id)
  where winner_team_id is not null and x.pair is not null and y.pair is not null
  order by match_id, match_date nulls last, x.team_id, y.team_id, round_name, round_phase),
-- the first rule that holds gives the weight; words are looked for in phase and name together
elo_round_weight as (
  select * exclude (words),
         case when is_final then 2.0::double when words similar to '.*(semi|final four).*' then 1.5 when contains(words, 'quarter') then 1.25
              when words similar to '.*(round of 16|ro16|16th).*' then 1.1 when is_pool_phase then 0.75 else 1.0 end as weight
  from (select *, lower(concat_ws(' ', nullif(round_phase, ''), nullif(round_name, ''))) as words from elo_match_feed)),
elo_seq as (
  select tournament_gender as gender, match_id, match_date, weight,
         case when is_winner_team1 then 1.0 else 0.0 end as s,
         team1_player_a_id as p1, team1_player_b_id as p2, team2_player_a_id as q1, team2_player_b_id as q2,
         (team1_player_a_id + 1) // 2 as i1, (team1_player_b_id + 1) // 2 as i2,
         (team2_player_a_id + 1) // 2 as j1, (team2_player_b_id + 1) // 2 as j2,
         row_number() over (partition by tournament_gender order by match_date, match_id) as n
  from elo_round_weight where match_date is not null),
elo_run as (
  select gender, cast(0 as bigint) as n,
         list_transform(range(32), lambda x: 1500.0::double) as st,
         list_transform(range(32), lambda x: 1500.0::double) as sw,
         cast(null as double) as e, cast(null as double) as ew
  from (select distinct gender from elo_seq) g
  union all
  select gender, n,
         list_transform(st, lambda v, ix: case when ix in (i1, i2) then v + dl when ix in (j1, j2) then v - dl else v end),
         list_transform(sw, lambda v, ix: case when ix in (i1, i2) then v + dlw when ix in (j1, j2) then v - dlw else v end),
         e, ew
  from (select x.*, 0.5 * (32.0 * (x.s - x.e)) as dl, 0.5 * (32.0 * x.weight * (x.s - x.ew)) as dlw
        from (select f.gender, f.n, f.i1, f.i2, f.j1, f.j2, f.s, f.weight, r.st, r.sw,
                     1.0 / (1.0 + pow(10.0::double, ((r.st[f.j1] + r.st[f.j2]) / 2.0 - (r.st[f.i1] + r.st[f.i2]) / 2.0) / 400.0)) as e,
                     1.0 / (1.0 + pow(10.0::double, ((r.sw[f.j1] + r.sw[f.j2]) / 2.0 - (r.sw[f.i1] + r.sw[f.i2]) / 2.0) / 400.0)) as ew
              from elo_run r join elo_seq f on f.gender = r.gender and f.n = r.n + 1) x) y),
elo_player_rows as (
  select distinct
         case k.k when 1 then s.p1 when 2 then s.p2 when 3 then s.q1 else s.q2 end as player_id,
         s.gender, s.match_date as as_of_date, s.match_id,
         case k.k when 1 then r.st[s.i1] when 2 then r.st[s.i2] when 3 then r.st[s.j1] else r.st[s.j2] end as elo,
         case k.k when 1 then r.sw[s.i1] when 2 then r.sw[s.i2] when 3 then r.sw[s.j1] else r.sw[s.j2] end as elo_rw,
         case when k.k <= 2 then r.e else 1.0 - r.e end as expected,
         case when k.k <= 2 then r.ew else 1.0 - r.ew end as expected_rw
  from elo_run r join elo_seq s on s.gender = r.gender and s.n = r.n
  cross join (select 1 as k union all select 2 union all select 3 union all select 4) k
  where r.n > 0),
elo_hist_std as (select player_id, gender, as_of_date, match_id, round(elo, 2) as elo_rating from elo_player_rows),
elo_hist_rw as (select player_id, gender, as_of_date, match_id, round(elo_rw, 2) as elo_rating from elo_player_rows)
"""


_PEOPLE = "select player_id, full_name as player_name, country_code as player_country_code, height_inches as player_height_inches from stg_players"
_EVENTS = "select match_id, tournament_id, t.name as tournament_name, t.season as tournament_season from stg_matches left join dim_tournaments t using (tournament_id)"


def history_mart(src: str) -> str:
    """The ratings with the player's and the match's context."""
    return f"select h.*, w.* exclude (player_id), g.* exclude (match_id) from {src} h left join ({_PEOPLE}) w using (player_id) left join ({_EVENTS}) g using (match_id)"


def latest_mart(src: str) -> str:
    """A player's last rating, and how often each stood in a match's line-up and won."""
    return f"""
, newest as (
  select player_id, gender, unnest(last({{'elo_rating': elo_rating, 'last_match_played_at': as_of_date, 'match_id': match_id}} order by as_of_date, match_id))
  from {src} group by player_id, gender),
entered as (
  select match_id, unnest(list_distinct([player_a_id, player_b_id])) as player_id, winner_team_id is not distinct from team_id as won
  from (select match_id, tournament_id, winner_team_id, unnest(list_distinct([team1_id, team2_id])) as team_id from stg_matches)
  join dim_team_tournaments using (team_id, tournament_id)),
totals as (
  select player_id, gender, count(*) as matches_played, count(*) filter (won) as wins from {src} join entered using (match_id, player_id) group by all)
select n.player_id, w.* exclude (player_id), n.gender, elo_rating, ifnull(matches_played, 0) as matches_played, cast(ifnull(wins, 0) as bigint) as wins,
       cast(ifnull(matches_played - wins, 0) as bigint) as losses, last_match_played_at, match_id as last_match_id,
       g.tournament_id as last_match_tournament_id, g.tournament_name as last_match_tournament_name, g.tournament_season as last_match_tournament_season
from newest n left join totals using (player_id, gender) left join ({_PEOPLE}) w using (player_id) left join ({_EVENTS}) g using (match_id)"""


ELO_SELECTS = {
    "elo_match_feed": "select * from elo_match_feed",
    "elo_round_weight": "select match_id, tournament_gender, round_phase, round_name, is_final, "
                        "is_pool_phase, weight from elo_round_weight",
    "elo_expected_score": "select player_id, gender, match_id, round(expected, 6) as expected_score, "
                          "round(expected_rw, 6) as expected_score_rw from elo_player_rows",
    "elo_history": history_mart("elo_hist_std"),
    "elo_history_components": history_mart("elo_hist_std"),
    "player_pools": """
, pool_edges as (
  select tournament_gender || ':' || cast(team1_player_a_id as varchar) as src,
         tournament_gender || ':' || cast(p as varchar) as dst
  from elo_match_feed, unnest([team1_player_b_id, team2_player_a_id, team2_player_b_id]) t(p)
  where match_date is not null),
und as (select src, dst from pool_edges union select dst, src from pool_edges),
reach(src, dst) as (
  select src, src from und
  union
  select r.src, u.dst from reach r join und u on u.src = r.dst)
select dst as node, min(src) as comp from reach group by dst""",
    "elo_history_round_weighted": history_mart("elo_hist_rw"),
    "elo_latest": latest_mart("elo_hist_std"),
    "elo_latest_round_weighted": latest_mart("elo_hist_rw"),
}
