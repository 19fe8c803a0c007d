"""Oracle SQL for the analytics queries (D1-D6), for all teams or players at once.

Everything starts from unpivoted rows: ``legs`` has a match once for each team
name or id on it, ``lineups`` a team once for each of its players.  Means are
rounded in whole-number arithmetic, written here and not taken from the library.
"""


def _mean(value: str, digits: int) -> str:
    """The mean of whole numbers, rounded half away from zero to ``digits``."""
    top, under = f"sum(cast({value} as hugeint)) * {10 ** digits}", f"count({value})"
    whole = f"abs({top}) // nullif({under}, 0)"
    rest = f"abs({top}) % nullif({under}, 0)"
    return f"cast(sign({top}) * ({whole} + if(2 * ({rest}) >= {under}, 1, 0)) as double) / {10 ** digits}"


def _mean_ratio(num: str, den: str, digits: int) -> str:
    """The exact mean of num / den over their least common denominator, rounded half away from zero to ``digits``."""
    over = f"list_reduce(list_distinct(list(cast({den} as hugeint))), lambda a, b: lcm(a, b))"
    top = f"list_sum(list_transform(list({{'n': cast({num} as hugeint), 'd': cast({den} as hugeint)}}), lambda x: x.n * ({over} // x.d))) * {10 ** digits}"
    under = f"({over} * count({num}))"
    return f"cast(sign({top}) * (abs({top}) // {under} + if(2 * (abs({top}) % {under}) >= {under}, 1, 0)) as double) / {10 ** digits}"


def _legs(first: str, second: str, name: str) -> str:
    """A match (each row of the fact) once for each ``name`` on it; won is unknown without a winner, and for a loss to a side without a name."""
    return f"""
, numbered as (select row_number() over () as leg, * from fct_matches),
legs as (
  select leg, tournament_id, {name}, bool_or(won) as won
  from (select leg, tournament_id, unnest([{{'{name}': {first}, 'won': if(is_winner_team1 or {second} is not null, is_winner_team1, null)}},
                                            {{'{name}': {second}, 'won': if(not is_winner_team1 or {first} is not null, not is_winner_team1, null)}}], recursive := true) from numbered)
  where {name} is not null group by leg, tournament_id, {name})"""


_HOSTS = "hosts as (select tournament_id, country_code as host_country, country_name as host_country_name from dim_tournaments)"
_LINEUPS = "lineups as (select team_id, tournament_id, unnest(list_distinct([player_a_id, player_b_id])) as player_id from dim_team_tournaments)"


def _record(who: str, legs: str, finishes: str) -> str:
    """Wins, losses and the mean finish of ``who`` by host country."""
    return f"""
select {who}, host_country, host_country_name, cast(count(*) filter (won) as int) as wins, cast(count(*) filter (not won) as int) as losses,
       cast(count(*) filter (won) + count(*) filter (not won) as int) as total_matches, any_value(mean_finish) as avg_finish_pos
from {legs} join hosts using (tournament_id)
left join (select {who}, host_country, {_mean("finishing_pos", 2)} as mean_finish
           from (select distinct {who}, host_country, tournament_id, finishing_pos from {finishes}) group by {who}, host_country) using ({who}, host_country)
group by {who}, host_country, host_country_name"""


def _figures(who: str, rows: str) -> str:
    """The mart's figures of ``who`` by host country."""
    return f"""
select {who}, tournament_country_code as host_country, tournament_country_name as host_country_name,
       cast(sum(match_wins) as int) as wins, cast(sum(match_losses) as int) as losses, cast(sum(match_wins + match_losses) as bigint) as total_matches,
       {_mean("finishing_pos", 2)} as avg_finish_pos, {_mean_ratio("quality_num", "quality_den", 4)} as avg_quality_win_loss_score,
       {_mean_ratio("quality_points_num", "quality_points_den", 4)} as avg_quality_win_loss_score_points, {_mean("sum_opponent_points_beaten", 2)} as avg_sum_opponent_points_beaten
from {rows} group by all"""


_OVER_TIME = """
select tournament_id, team_id, team_display_name, tournament_name, tournament_country_code, tournament_country_name, season, season_year,
       tournament_start_date, tournament_tier, tournament_gender, tournament_is_major, finishing_pos, tournament_points,
       columns(lambda c: c in ('sum_opponent_points_beaten', 'match_wins', 'match_losses', 'wins_vs_higher_seed', 'losses_vs_lower_seed', 'pool_wins',
                               'elimination_wins', 'quality_win_loss_score', 'quality_win_loss_score_points'))
from tournament_mart"""

ANALYTICS_SELECTS = {
    "teams_list": "select team_display_name from dim_team_tournaments where team_display_name is not null group by all",
    "players_list": "select player_id, full_name from stg_players where full_name is not null",
    "perf_country_team_core": _legs("team1_display_name", "team2_display_name", "team_display_name") + f", {_HOSTS}" + _record(
        "team_display_name", "legs",
        "legs join hosts using (tournament_id) join fct_tournament_standings using (tournament_id, team_display_name)"),
    "perf_country_team": _figures("team_display_name", "tournament_mart"),
    "perf_country_player": f", {_LINEUPS}" + _figures("player_id", "tournament_mart join lineups using (team_id, tournament_id) where player_id is not null"),
    "perf_country_player_core": _legs("team1_id", "team2_id", "team_id") + f", {_HOSTS}, {_LINEUPS}, player_legs as (select * from legs join lineups using (team_id, tournament_id) where player_id is not null)" + _record(
        "player_id", "player_legs",
        "lineups join hosts using (tournament_id) join fct_tournament_standings using (tournament_id, team_id) where player_id is not null"),
    "perf_over_time": _OVER_TIME + " where tournament_is_major and tournament_gender = 'W' and season_year is not null",
    "perf_over_time_all": _OVER_TIME + " where tournament_start_date is not null",
}
