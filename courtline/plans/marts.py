"""Mart models M14-M16: match, tournament-team and champion marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.operators.pairs import asof_latest, latest_per_key, pair_key
from courtline.plans.core import ranking_snapshots

# Quality scores are rational numbers; they are reported as doubles rounded here.
SCORE_DECIMALS = 6


def match_mart(fm: DataFrame, dim_t: DataFrame, stg_rounds: DataFrame, dim_tt: DataFrame,
               standings: DataFrame) -> DataFrame:
    """One row per match (and per duplicated round code) with all context."""
    m = fm.alias("m")
    dt = dim_t.alias("dt")
    r = stg_rounds.select("tournament_id", "code", "start_date", "end_date",
                          "rank_method").alias("r")
    tcols = ["team_id", "tournament_id", "player_a_id", "player_b_id", "player_a_name",
             "player_b_name", "player_a_height_inches", "player_b_height_inches"]
    t1, t2 = dim_tt.select(*tcols).alias("t1"), dim_tt.select(*tcols).alias("t2")
    scols = ["tournament_id", "team_id", "finishing_pos", "points", "prize_money",
             "entry_ranking_position", "entry_ranking_points"]
    s1, s2 = standings.select(*scols).alias("s1"), standings.select(*scols).alias("s2")
    tid = F.col("m.tournament_id")
    j = (m.join(dt, F.col("dt.tournament_id") == tid, "left")
         .join(r, (F.col("r.tournament_id") == tid) & (F.col("r.code") == F.col("m.round_code")),
               "left")
         .join(t1, (F.col("t1.team_id") == F.col("m.team1_id")) & (F.col("t1.tournament_id") == tid),
               "left")
         .join(t2, (F.col("t2.team_id") == F.col("m.team2_id")) & (F.col("t2.tournament_id") == tid),
               "left")
         .join(s1, (F.col("s1.tournament_id") == tid) & (F.col("s1.team_id") == F.col("m.team1_id")),
               "left")
         .join(s2, (F.col("s2.tournament_id") == tid) & (F.col("s2.team_id") == F.col("m.team2_id")),
               "left"))

    def team(n: int) -> list:
        t, s = f"t{n}", f"s{n}"
        p = f"team{n}_"
        return [
            F.col(f"m.team{n}_display_name"), F.col(f"m.team{n}_country_code"),
            F.col(f"{t}.player_a_id").alias(p + "player_a_id"),
            F.col(f"{t}.player_b_id").alias(p + "player_b_id"),
            F.col(f"{t}.player_a_name").alias(p + "player_a_name"),
            F.col(f"{t}.player_b_name").alias(p + "player_b_name"),
            F.col(f"{t}.player_a_height_inches").alias(p + "player_a_height_inches"),
            F.col(f"{t}.player_b_height_inches").alias(p + "player_b_height_inches"),
            F.col(f"m.team{n}_ranking_position"),
            F.col(f"{s}.finishing_pos").alias(p + "finishing_pos"),
            F.col(f"{s}.points").alias(p + "tournament_points"),
            F.col(f"{s}.prize_money").alias(p + "prize_money"),
            F.col(f"{s}.entry_ranking_position").alias(p + "entry_ranking_position"),
            F.col(f"{s}.entry_ranking_points").alias(p + "entry_ranking_points"),
        ]

    return j.select(
        "m.match_id", "m.tournament_id", "m.played_at", "m.match_date", "m.match_phase",
        "m.round_code", "m.team1_id", "m.team2_id", "m.winner_team_id", "m.score_sets",
        "m.duration_minutes", "m.result_type", "m.match_status", "m.tournament_name", "m.season",
        "m.tournament_gender", "m.tournament_tier",
        F.col("dt.start_date").alias("tournament_start_date"),
        F.col("dt.end_date").alias("tournament_end_date"),
        F.col("dt.duration_days").alias("tournament_duration_days"),
        F.col("dt.city").alias("tournament_city"),
        F.col("dt.country_code").alias("tournament_country_code"),
        F.col("dt.country_name").alias("tournament_country_name"),
        F.col("dt.status").alias("tournament_status"),
        F.col("dt.timezone").alias("tournament_timezone"),
        F.col("dt.season_year").alias("tournament_season_year"),
        F.col("dt.is_major").alias("tournament_is_major"),
        "m.round_name", "m.round_bracket", "m.round_phase",
        F.col("r.start_date").alias("round_start_date"),
        F.col("r.end_date").alias("round_end_date"),
        F.col("r.rank_method").alias("round_rank_method"),
        *team(1), *team(2),
        "m.is_winner_team1", "m.is_final", "m.is_pool_phase", "m.higher_seed_won")


def team_match_rows(fm: DataFrame) -> DataFrame:
    """Unpivot each match once into its side rows and its win row.

    ``kind='side'``: one row per present team (team, opponent, won).
    ``kind='win'``: one row per decided match for the winner, the opponent
    being the other listed team.  One scan of the matches feeds both.
    """
    w, t1, t2 = F.col("winner_team_id"), F.col("team1_id"), F.col("team2_id")
    rows = F.array(
        F.struct(F.lit("side").alias("kind"), t1.alias("team_id"), t2.alias("opponent_team_id"),
                 (w == t1).alias("won")),
        F.struct(F.lit("side").alias("kind"), t2.alias("team_id"), t1.alias("opponent_team_id"),
                 (w == t2).alias("won")),
        F.struct(F.lit("win").alias("kind"), w.alias("team_id"),
                 F.when(w == t1, t2).otherwise(t1).alias("opponent_team_id"),
                 F.lit(True).alias("won")))
    return (fm.select("tournament_id", "match_id", w.isNotNull().alias("has_winner"),
                      "is_pool_phase", "higher_seed_won", F.explode(rows).alias("x"))
            .select("tournament_id", "match_id", "has_winner", "is_pool_phase",
                    "higher_seed_won", "x.*")
            .filter(F.col("team_id").isNotNull()))


def tournament_mart(fm: DataFrame, standings: DataFrame, dim_t: DataFrame) -> DataFrame:
    """One row per (tournament, team) of the standings with match metrics.

    All per-team metrics come from a single aggregation.  The two quality
    scores are sums of ratios with a per-tournament denominator, so we sum
    the integer numerators exactly and divide once.  Both numbers are kept
    beside the rounded score (``quality_num`` / ``quality_den``, and the same
    for points), so that averages over tournaments are exact.
    """
    tstats = standings.groupBy("tournament_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_teams"),
        F.greatest(F.max(F.coalesce(F.col("entry_ranking_points"), F.lit(0))), F.lit(1))
         .alias("max_entry_points"))
    opp = standings.select("tournament_id", F.col("team_id").alias("opponent_team_id"),
                           F.col("finishing_pos").alias("opp_pos"),
                           F.col("points").alias("opp_points"),
                           F.col("entry_ranking_points").alias("opp_entry_points"))
    x = (team_match_rows(fm)
         .join(opp, ["tournament_id", "opponent_team_id"], "left")
         .join(tstats, "tournament_id", "left"))

    side, win = F.col("kind") == "side", F.col("kind") == "win"
    won, dec = F.col("won"), F.col("has_winner")
    hsw_false = F.col("higher_seed_won") == F.lit(False)
    n = F.col("n_teams")
    n1 = F.nullif(n - 1, F.lit(0))
    cpos = F.coalesce(F.col("opp_pos"), n)
    qnum = (F.when(~dec | n1.isNull(), F.lit(0))
            .when(won, n - cpos).otherwise(1 - cpos))
    mx = F.col("max_entry_points")
    epts = F.coalesce(F.col("opp_entry_points"), F.lit(0))
    pnum = F.when(~dec | mx.isNull(), F.lit(0)).when(won, epts).otherwise(epts - mx)

    agg = x.groupBy("tournament_id", "team_id").agg(
        F.count_if(side).cast("int").alias("matches_played"),
        F.count_if(side & won).cast("int").alias("match_wins"),
        F.count_if(side & dec & ~won).cast("int").alias("match_losses"),
        F.count_if(side & won & hsw_false).cast("int").alias("wins_vs_higher_seed"),
        F.count_if(side & dec & ~won & hsw_false).cast("int").alias("losses_vs_lower_seed"),
        F.count_if(side & won & F.coalesce(F.col("is_pool_phase"), F.lit(False)))
         .cast("int").alias("pool_wins"),
        F.count_if(side & won & ~F.coalesce(F.col("is_pool_phase"), F.lit(True)))
         .cast("int").alias("elimination_wins"),
        F.count_if(win).alias("_n_win"),
        F.count_if(win & F.col("opp_points").isNotNull()).alias("_n_win_pts"),
        F.sum(F.when(win, F.col("opp_points"))).alias("_sum_win_pts"),
        F.sum(F.when(side, qnum)).alias("_qnum"),
        F.max(F.when(side, n1)).alias("_qden"),  # a team known only as a winner has no score
        F.sum(F.when(side, pnum)).alias("_pnum"),
        F.max(F.when(side, mx)).alias("_pden"),
    ).select(
        "tournament_id", "team_id", "matches_played", "match_wins", "match_losses",
        "wins_vs_higher_seed", "losses_vs_lower_seed", "pool_wins", "elimination_wins",
        F.when((F.col("_n_win") > 0) & (F.col("_n_win") == F.col("_n_win_pts")),
               F.col("_sum_win_pts").cast("int")).alias("sum_opponent_points_beaten"),
        F.round(F.col("_qnum") / F.col("_qden"), SCORE_DECIMALS).alias("quality_win_loss_score"),
        F.round(F.col("_pnum") / F.col("_pden"), SCORE_DECIMALS)
         .alias("quality_win_loss_score_points"),
        F.when(F.col("_qden").isNotNull(), F.col("_qnum")).alias("quality_num"), F.col("_qden").cast("int").alias("quality_den"),
        F.when(F.col("_pden").isNotNull(), F.col("_pnum")).alias("quality_points_num"), F.col("_pden").cast("int").alias("quality_points_den")).alias("a")

    s = standings.alias("s")
    dt = dim_t.alias("dt")
    j = (s.join(dt, F.col("dt.tournament_id") == F.col("s.tournament_id"), "left")
         .join(agg, (F.col("a.tournament_id") == F.col("s.tournament_id"))
               & (F.col("a.team_id") == F.col("s.team_id")), "left"))
    zero = lambda c: F.coalesce(F.col(f"a.{c}"), F.lit(0)).alias(c)
    return j.select(
        "s.tournament_id", "s.team_id", "s.tournament_name", "dt.season", "dt.season_year",
        F.col("dt.tier").alias("tournament_tier"), F.col("dt.gender").alias("tournament_gender"),
        F.col("dt.start_date").alias("tournament_start_date"),
        F.col("dt.end_date").alias("tournament_end_date"),
        F.col("dt.duration_days").alias("tournament_duration_days"),
        F.col("dt.city").alias("tournament_city"),
        F.col("dt.country_code").alias("tournament_country_code"),
        F.col("dt.country_name").alias("tournament_country_name"),
        F.col("dt.status").alias("tournament_status"),
        F.col("dt.timezone").alias("tournament_timezone"),
        F.col("dt.is_major").alias("tournament_is_major"),
        "s.team_display_name", "s.player_a_name", "s.player_b_name", "s.team_country_code",
        "s.finishing_pos", F.col("s.points").alias("tournament_points"), "s.prize_money",
        "s.entry_ranking_position", "s.entry_ranking_points", "s.entry_ranking_snapshot_date",
        "s.is_podium", "s.is_champion", "a.sum_opponent_points_beaten",
        zero("matches_played"), zero("match_wins"), zero("match_losses"),
        zero("wins_vs_higher_seed"), zero("losses_vs_lower_seed"), zero("pool_wins"),
        zero("elimination_wins"),
        F.coalesce(F.col("a.quality_win_loss_score"), F.lit(0.0)).alias("quality_win_loss_score"),
        F.coalesce(F.col("a.quality_win_loss_score_points"), F.lit(0.0))
         .alias("quality_win_loss_score_points"),
        *[F.coalesce(F.col(f"a.{c}"), F.lit(empty)).cast(t).alias(c) for c, empty, t in (
            ("quality_num", 0, "long"), ("quality_den", 1, "int"), ("quality_points_num", 0, "long"), ("quality_points_den", 1, "int"))])


def champion_mart(standings: DataFrame, dim_t: DataFrame, fm: DataFrame, dim_tt: DataFrame,
                  stg_rankings: DataFrame, method: str = "fill") -> DataFrame:
    """One row per champion (and per final it won) with ranking at the event."""
    s = standings.filter(F.col("is_champion"))
    t = dim_t
    fin = (fm.filter(F.col("is_final") & F.col("winner_team_id").isNotNull())
           .select("tournament_id", F.col("winner_team_id").alias("team_id"),
                   F.col("match_date").alias("final_played_at"),
                   F.col("score_sets").alias("final_score_sets"),
                   F.col("duration_minutes").alias("final_duration_minutes"),
                   F.col("round_name").alias("final_round_name"),
                   F.when(F.col("team1_id") == F.col("winner_team_id"), F.col("team2_display_name"))
                    .otherwise(F.col("team1_display_name")).alias("final_opponent_display_name"),
                   F.when(F.col("team1_id") == F.col("winner_team_id"), F.col("team2_country_code"))
                    .otherwise(F.col("team1_country_code")).alias("final_opponent_country_code")))
    lo, hi = pair_key("player_a_id", "player_b_id")
    ev = (s.select("tournament_id", "team_id")
          .join(dim_tt.select("team_id", "tournament_id", "player_a_id", "player_b_id"),
                ["team_id", "tournament_id"])
          .join(t.select("tournament_id", "end_date", "gender"), "tournament_id")
          .select("tournament_id", "team_id", "gender", lo.alias("p_lo"), hi.alias("p_hi"),
                  "end_date")
          .filter(F.col("p_lo").isNotNull()))
    vals = ["ranking_type", "position", "is_top_10", "is_top_16"]
    best = asof_latest(ev, ranking_snapshots(stg_rankings), on=["gender", "p_lo", "p_hi"],
                       event_date="end_date", snap_date="snapshot_date", values=vals,
                       tie_break=["ranking_type", "position"], method=method)
    lr = latest_per_key(ev.join(best, ["gender", "p_lo", "p_hi", "end_date"]),
                        ["tournament_id", "team_id"],
                        [F.col("snapshot_date").desc(), "ranking_type", "position"]).select(
        "tournament_id", "team_id",
        F.col("position").alias("ranking_position_at_tournament"),
        F.col("ranking_type").alias("ranking_type_at_tournament"),
        F.col("snapshot_date").alias("ranking_snapshot_date"),
        F.col("is_top_10").alias("is_top_10_at_tournament"),
        F.col("is_top_16").alias("is_top_16_at_tournament"))
    j = (s.alias("s").join(t.alias("t"), F.col("t.tournament_id") == F.col("s.tournament_id"))
         .join(fin.alias("fm"), (F.col("fm.tournament_id") == F.col("s.tournament_id"))
               & (F.col("fm.team_id") == F.col("s.team_id")), "left")
         .join(lr.alias("lr"), (F.col("lr.tournament_id") == F.col("s.tournament_id"))
               & (F.col("lr.team_id") == F.col("s.team_id")), "left"))
    return j.select(
        "s.tournament_id", "s.team_id", "s.tournament_name", "s.season", "t.season_year",
        "s.tournament_gender", "s.tournament_tier", "s.is_major",
        F.col("t.start_date").alias("tournament_start_date"),
        F.col("t.end_date").alias("tournament_end_date"),
        F.col("t.duration_days").alias("tournament_duration_days"),
        F.col("t.city").alias("tournament_city"),
        F.col("t.country_code").alias("tournament_host_country_code"),
        F.col("t.country_name").alias("tournament_host_country_name"),
        F.col("t.status").alias("tournament_status"),
        F.col("t.timezone").alias("tournament_timezone"),
        F.col("s.team_display_name").alias("champion_team_display_name"),
        F.col("s.player_a_name").alias("champion_player_a_name"),
        F.col("s.player_b_name").alias("champion_player_b_name"),
        F.col("s.team_country_code").alias("champion_country_code"),
        "s.finishing_pos", "s.points", "s.prize_money",
        "fm.final_played_at", "fm.final_opponent_display_name", "fm.final_opponent_country_code",
        "fm.final_score_sets", "fm.final_duration_minutes", "fm.final_round_name",
        "lr.ranking_position_at_tournament", "lr.ranking_type_at_tournament",
        "lr.ranking_snapshot_date", "lr.is_top_10_at_tournament", "lr.is_top_16_at_tournament")
