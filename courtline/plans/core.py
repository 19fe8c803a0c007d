"""Core models M9-M13: dimensions and facts.

Each model is a function of DataFrames.  The two as-of enrichments (ranking of
each match side at the match date, entry ranking of each team at the
tournament start) use the pair-key rewrite of ``courtline.operators.pairs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.operators.pairs import asof_latest, latest_per_key, pair_key

# Fixed values of the model definitions.
MAJOR_TIERS = ("World Championship", "Olympic Games")
FINAL_PHASES = ("final", "finals", "gold medal match")
POOL_PHASES = ("pool", "pools", "pool play")
POOL_BRACKET = "Pool"
ENTRY_RANKING_TYPE = "beach_world_tour"
TOP_10, TOP_16 = 10, 16


def dim_tournaments(stg_tournaments: DataFrame) -> DataFrame:
    t = stg_tournaments
    season_year = F.nullif(
        F.regexp_replace(F.split_part(F.col("season"), F.lit("-"), F.lit(1)), r"\D", ""),
        F.lit("")).try_cast("int")
    return t.select(
        "tournament_id", "name", "season", "tier", "start_date", "end_date", "city",
        "country_code", "country_name", "gender", "status", "timezone",
        (F.datediff("end_date", "start_date") + 1).cast("int").alias("duration_days"),
        season_year.alias("season_year"),
        F.coalesce(F.col("tier").isin(*MAJOR_TIERS), F.lit(False)).alias("is_major"))


def dim_team_tournaments(stg_teams: DataFrame, stg_players: DataFrame,
                         dim_t: DataFrame) -> DataFrame:
    tt = stg_teams.alias("tt")
    pa = stg_players.select("player_id", "full_name", "height_inches").alias("pa")
    pb = stg_players.select("player_id", "full_name", "height_inches").alias("pb")
    dt = dim_t.select("tournament_id", "name", "season", "gender").alias("dt")
    name = lambda c: F.coalesce(c, F.lit("Unknown"))
    return (tt.join(pa, F.col("pa.player_id") == F.col("tt.player_a_id"), "left")
            .join(pb, F.col("pb.player_id") == F.col("tt.player_b_id"), "left")
            .join(dt, F.col("dt.tournament_id") == F.col("tt.tournament_id"), "left")
            .select("tt.team_id", "tt.tournament_id", "tt.player_a_id", "tt.player_b_id",
                    "tt.country_code", "tt.status", "tt.valid_from", "tt.valid_to",
                    F.col("pa.full_name").alias("player_a_name"),
                    F.col("pb.full_name").alias("player_b_name"),
                    F.col("pa.height_inches").alias("player_a_height_inches"),
                    F.col("pb.height_inches").alias("player_b_height_inches"),
                    F.col("dt.name").alias("tournament_name"), F.col("dt.season"),
                    F.col("dt.gender").alias("tournament_gender"),
                    F.concat(name(F.col("pa.full_name")), F.lit(" / "),
                             name(F.col("pb.full_name"))).alias("team_display_name")))


def ranking_flags(rankings: DataFrame) -> DataFrame:
    """Ranking rows with the derived top-N flags (no player lookups)."""
    return rankings.select(
        "*", (F.col("position") <= TOP_10).alias("is_top_10"),
        (F.col("position") <= TOP_16).alias("is_top_16"))


def fct_team_rankings(stg_rankings: DataFrame, stg_players: DataFrame) -> DataFrame:
    tr = stg_rankings.alias("tr")
    p1 = stg_players.select("player_id", "full_name", "country_code").alias("p1")
    p2 = stg_players.select("player_id", "full_name", "country_code").alias("p2")
    return (tr.join(p1, F.col("p1.player_id") == F.col("tr.no_player1"), "left")
            .join(p2, F.col("p2.player_id") == F.col("tr.no_player2"), "left")
            .select("tr.ranking_type", "tr.snapshot_date", "tr.gender", "tr.position",
                    "tr.earned_points", "tr.no_player1", "tr.no_player2", "tr.team_name",
                    F.col("p1.full_name").alias("player1_name"),
                    F.col("p2.full_name").alias("player2_name"),
                    F.coalesce("p1.country_code", "p2.country_code").alias("country_code"),
                    (F.col("tr.position") <= TOP_10).alias("is_top_10"),
                    (F.col("tr.position") <= TOP_16).alias("is_top_16")))


def ranking_snapshots(stg_rankings: DataFrame) -> DataFrame:
    """Rankings keyed by (gender, p_lo, p_hi) for the as-of joins."""
    lo, hi = pair_key("no_player1", "no_player2")
    return ranking_flags(stg_rankings).select(
        "gender", lo.alias("p_lo"), hi.alias("p_hi"), "snapshot_date", "ranking_type",
        "position", "earned_points", "is_top_10", "is_top_16")


def _phase_text(r_phase: Column, m_phase: Column) -> Column:
    return F.lower(F.coalesce(r_phase, m_phase, F.lit("")))


def match_base(stg_matches: DataFrame, dim_t: DataFrame, stg_rounds: DataFrame,
               dim_tt: DataFrame) -> DataFrame:
    """Matches with tournament, round and both teams (the left-join spine).

    Players come with the stored team dimension, which is far smaller than the
    matches; so match rows are only ever dealt out by (tournament, team), of
    which there are many, and never by a single player.

    A duplicated (tournament, round code) multiplies matches here, as the
    model definition does; nothing downstream hides it except the Elo feed.
    """
    m = stg_matches.alias("m")
    dt = dim_t.select("tournament_id", "name", "season", "gender", "tier",
                      "start_date").alias("dt")
    r = stg_rounds.select("tournament_id", "code", "start_date", "name", "bracket",
                          "phase").alias("r")
    j = (m.join(dt, F.col("dt.tournament_id") == F.col("m.tournament_id"), "left")
         .join(r, (F.col("r.tournament_id") == F.col("m.tournament_id"))
               & (F.col("r.code") == F.col("m.round_code")), "left"))
    for n in (1, 2):
        team = dim_tt.select(*[F.col(c).alias(f"t{n}_{c}") for c in (
            "team_id", "tournament_id", "player_a_id", "player_b_id", "country_code", "team_display_name")])
        j = j.join(team, (F.col(f"t{n}_tournament_id") == F.col("m.tournament_id"))
                   & (F.col(f"t{n}_team_id") == F.col(f"m.team{n}_id")), "left")
    match_ts = F.coalesce(F.col("m.played_at"), F.col("r.start_date"), F.col("dt.start_date"))
    return j.select(
        "m.match_id", "m.tournament_id", "m.played_at",
        F.col("r.start_date").alias("round_start_date"),
        F.to_date(match_ts).alias("match_date"),
        F.col("m.phase").alias("match_phase"), "m.round_code", "m.team1_id", "m.team2_id",
        "m.winner_team_id", "m.score_sets", "m.duration_minutes", "m.result_type",
        F.col("m.status").alias("match_status"),
        F.col("dt.name").alias("tournament_name"), F.col("dt.season"),
        F.col("dt.gender").alias("tournament_gender"), F.col("dt.tier").alias("tournament_tier"),
        F.col("r.name").alias("round_name"), F.col("r.bracket").alias("round_bracket"),
        F.col("r.phase").alias("round_phase"),
        F.col("t1_team_display_name").alias("team1_display_name"),
        F.col("t2_team_display_name").alias("team2_display_name"),
        F.col("t1_country_code").alias("team1_country_code"),
        F.col("t2_country_code").alias("team2_country_code"),
        # join markers and pair members for the ranking lookup
        F.col("dt.tournament_id").isNotNull().alias("_has_t"),
        F.col("t1_team_id").isNotNull().alias("_has_t1"),
        F.col("t2_team_id").isNotNull().alias("_has_t2"),
        F.col("t1_player_a_id").alias("_t1_pa"), F.col("t1_player_b_id").alias("_t1_pb"),
        F.col("t2_player_a_id").alias("_t2_pa"), F.col("t2_player_b_id").alias("_t2_pb"))


def match_side_rankings(base: DataFrame, snaps: DataFrame, method: str = "fill") -> DataFrame:
    """Ranking position of each match side at the match date: (match_id, pos1, pos2).

    Only matches whose tournament and both team rows exist take part.  A
    ranking of a pair that is on both sides counts for side 1 only.  On equal
    snapshot dates ``ranking_type`` decides (ascending), then ``position``.
    """
    ok = base.filter(F.col("_has_t") & F.col("_has_t1") & F.col("_has_t2"))
    lo1, hi1 = pair_key("_t1_pa", "_t1_pb")
    lo2, hi2 = pair_key("_t2_pa", "_t2_pb")
    same = (lo1 == lo2) & (hi1 == hi2)
    sides = F.array(
        F.struct(F.lit(1).alias("side"), lo1.alias("p_lo"), hi1.alias("p_hi")),
        F.struct(F.lit(2).alias("side"),
                 F.when(same, F.lit(None)).otherwise(lo2).alias("p_lo"),
                 F.when(same, F.lit(None)).otherwise(hi2).alias("p_hi")))
    ev = (ok.select("match_id", F.col("tournament_gender").alias("gender"), "match_date",
                    F.explode(sides).alias("s"))
          .select("match_id", "gender", "match_date", "s.side", "s.p_lo", "s.p_hi")
          .filter(F.col("p_lo").isNotNull()))
    best = asof_latest(ev, snaps, on=["gender", "p_lo", "p_hi"], event_date="match_date",
                       snap_date="snapshot_date", values=["ranking_type", "position"],
                       tie_break=["ranking_type", "position"], method=method)
    hit = ev.join(best, ["gender", "p_lo", "p_hi", "match_date"])
    # newest snapshot per (match, side) across fan-out rows, in the aggregation that
    # pivots the sides.  Candidates of one side share the pair, so two with the same
    # snapshot date are the same (already tie-broken) snapshot: max_by on the date is
    # exact, and its fixed-width buffer keeps the aggregation hash-based.
    def side_pos(n: int):
        return F.max_by(F.col("position"), F.when(F.col("side") == n, F.col("snapshot_date")))

    return hit.groupBy("match_id").agg(side_pos(1).alias("team1_ranking_position"),
                                       side_pos(2).alias("team2_ranking_position"))


FCT_MATCH_COLUMNS = [
    "match_id", "tournament_id", "played_at", "round_start_date", "match_date", "match_phase",
    "round_code", "team1_id", "team2_id", "winner_team_id", "score_sets", "duration_minutes",
    "result_type", "match_status", "tournament_name", "season", "tournament_gender",
    "tournament_tier", "round_name", "round_bracket", "round_phase", "team1_display_name",
    "team2_display_name", "team1_country_code", "team2_country_code",
    "team1_ranking_position", "team2_ranking_position", "is_winner_team1", "is_final",
    "is_pool_phase", "higher_seed_won"]


def fct_matches(base: DataFrame, stg_rankings: DataFrame, method: str = "fill") -> DataFrame:
    """M12 from the spine of :func:`match_base`, best a stored table: it is read for the as-of keys,
    for their way back to matches, and for the output."""
    ranks = match_side_rankings(base, ranking_snapshots(stg_rankings), method)
    j = base.join(ranks, "match_id", "left")
    winner, t1 = F.col("winner_team_id"), F.col("team1_id")
    r1, r2 = F.col("team1_ranking_position"), F.col("team2_ranking_position")
    phase = _phase_text(F.col("round_phase"), F.col("match_phase"))
    return j.select(
        *FCT_MATCH_COLUMNS[:27],
        (winner == t1).alias("is_winner_team1"),
        phase.isin(*FINAL_PHASES).alias("is_final"),
        (phase.isin(*POOL_PHASES) | (F.col("round_bracket") == POOL_BRACKET)).alias("is_pool_phase"),
        F.when(winner.isNull(), F.lit(None).cast("boolean"))
         .when(r1.isNull() | r2.isNull(), F.lit(None).cast("boolean"))
         .when(winner == t1, r1 < r2)
         .otherwise(r2 < r1).alias("higher_seed_won"))


def fct_tournament_standings(stg_results: DataFrame, dim_t: DataFrame, dim_tt: DataFrame,
                             stg_rankings: DataFrame, method: str = "fill") -> DataFrame:
    r = stg_results.alias("r")
    dt = dim_t.select("tournament_id", "name", "season", "gender", "tier", "is_major",
                      "start_date").alias("dt")
    dtt = dim_tt.select("team_id", "tournament_id", "player_a_id", "player_b_id",
                        "team_display_name", "player_a_name", "player_b_name",
                        "country_code").alias("dtt")
    j = (r.join(dt, F.col("dt.tournament_id") == F.col("r.tournament_id"), "left")
         .join(dtt, (F.col("dtt.team_id") == F.col("r.team_id"))
               & (F.col("dtt.tournament_id") == F.col("r.tournament_id")), "left"))
    lo, hi = pair_key(F.col("dtt.player_a_id"), F.col("dtt.player_b_id"))
    ev = (j.filter(F.col("dt.tournament_id").isNotNull() & F.col("dtt.team_id").isNotNull())
          .select(F.col("r.tournament_id").alias("tournament_id"),
                  F.col("r.team_id").alias("team_id"), F.col("dt.gender").alias("gender"),
                  lo.alias("p_lo"), hi.alias("p_hi"), F.col("dt.start_date").alias("start_date"))
          .filter(F.col("p_lo").isNotNull()))
    snaps = ranking_snapshots(stg_rankings).filter(F.col("ranking_type") == ENTRY_RANKING_TYPE)
    best = asof_latest(ev, snaps, on=["gender", "p_lo", "p_hi"], event_date="start_date",
                       snap_date="snapshot_date", values=["position", "earned_points"],
                       tie_break=["position"], method=method)
    er = latest_per_key(ev.join(best, ["gender", "p_lo", "p_hi", "start_date"]),
                        ["tournament_id", "team_id"],
                        [F.col("snapshot_date").desc(), "position"]).alias("er")
    out = j.join(er, (F.col("er.tournament_id") == F.col("r.tournament_id"))
                 & (F.col("er.team_id") == F.col("r.team_id")), "left")
    return out.select(
        "r.tournament_id", "r.team_id", "r.finishing_pos", "r.points", "r.prize_money",
        F.col("dt.name").alias("tournament_name"), F.col("dt.season"),
        F.col("dt.gender").alias("tournament_gender"), F.col("dt.tier").alias("tournament_tier"),
        F.col("dt.is_major"), F.col("dtt.team_display_name"), F.col("dtt.player_a_name"),
        F.col("dtt.player_b_name"), F.col("dtt.country_code").alias("team_country_code"),
        F.col("er.position").alias("entry_ranking_position"),
        F.col("er.earned_points").alias("entry_ranking_points"),
        F.col("er.snapshot_date").alias("entry_ranking_snapshot_date"),
        (F.col("r.finishing_pos") <= 3).alias("is_podium"),
        (F.col("r.finishing_pos") == 1).alias("is_champion"))
