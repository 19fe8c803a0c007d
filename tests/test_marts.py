"""Tournament-mart rules on a hand-built raw layer."""

import datetime as d

import pytest

from courtline.league import League

D = d.date(2020, 5, 1)


@pytest.fixture(scope="module")
def mart(spark):
    mk = spark.createDataFrame
    raw = {
        "players": mk([(i, None, None, f"P{i}", "M", None, 180, "X", None) for i in range(1, 13)],
                      "player_id long, first_name string, last_name string, full_name string, gender string, "
                      "birth_date date, height_cm int, country_code string, profile_url string"),
        "tournaments": mk([(1, "T1", "2020", "Open", D, D, None, "C1", "Country", "M", None, None),
                           (2, "T2", "2020", "Open", D, D, None, "C1", "Country", "M", None, None)],
                          "tournament_id long, name string, season string, tier string, start_date date, "
                          "end_date date, city string, country_code string, country_name string, gender string, "
                          "status string, timezone string"),
        "teams": mk([(t, tid, 2 * t - 1, 2 * t, "N", None, None, None) for t, tid in
                     ((1, 1), (2, 1), (3, 1), (8, 2), (9, 2))],
                    "team_id long, tournament_id long, player_a_id long, player_b_id long, country_code string, "
                    "status string, valid_from date, valid_to date"),
        "matches": mk([(1, 1, None, "PA", 1, 2, 1), (2, 1, None, "QF", 1, 3, 3), (3, 1, None, "SF", 2, 3, None),
                       (4, 2, None, "PA", 9, 8, 9)],
                      "match_id long, tournament_id long, phase string, round string, team1_id long, "
                      "team2_id long, winner_team_id long")
        .selectExpr("*", "cast(null as string) as score_sets", "cast(null as int) as duration_minutes",
                    "cast(null as timestamp) as played_at", "cast(null as string) as result_type",
                    "cast(null as string) as status"),
        "results": mk([(1, 1, 1, 100, None), (1, 3, 2, None, None), (1, 2, 3, 50, None), (2, 9, 1, 10, None)],
                      "tournament_id long, team_id long, finishing_pos int, points int, prize_money double"),
        "rounds": mk([(10, 1, "PA", "Pool A", "Pool", None, D), (11, 1, "QF", "Quarterfinals", None, None, D),
                      (20, 2, "PA", "Pool A", "Pool", None, D)],
                     "round_id long, tournament_id long, code string, name string, bracket string, phase string, "
                     "start_date date")
        .selectExpr("*", "cast(null as date) as end_date", "cast(null as string) as rank_method"),
        "team_rankings": mk([], "ranking_type string, snapshot_date date, gender string, position int, "
                                "no_player1 long, no_player2 long, team_name string, earned_points int"),
    }
    lg = League(raw)
    return {(r.tournament_id, r.team_id): r for r in lg.tournament_mart.collect()}


def test_counts_and_unknown_phase(mart):
    t1, t3, t2 = mart[(1, 1)], mart[(1, 3)], mart[(1, 2)]
    assert (t1.matches_played, t1.match_wins, t1.match_losses) == (2, 1, 1)
    assert (t1.pool_wins, t1.elimination_wins) == (1, 0)
    # the QF round has no bracket and no phase: is_pool_phase is NULL, so the win is neither
    assert (t3.match_wins, t3.pool_wins, t3.elimination_wins) == (1, 0, 0)
    # the undecided match counts as played, not as a loss
    assert (t2.matches_played, t2.match_wins, t2.match_losses) == (2, 0, 1)


def test_all_or_null_sum(mart):
    assert mart[(1, 2)].sum_opponent_points_beaten is None       # no wins: no row, NULL
    assert mart[(1, 1)].sum_opponent_points_beaten == 50         # beat team 2 (50 points)
    assert mart[(1, 3)].sum_opponent_points_beaten == 100


def test_quality_scores(mart):
    # n = 3: win over pos 3 adds (3-3)/2 = 0, loss to pos 2 subtracts (2-1)/2
    assert mart[(1, 1)].quality_win_loss_score == -0.5
    assert mart[(1, 3)].quality_win_loss_score == 1.0            # beat the champion: (3-1)/2
    # a one-team tournament scores 0; an opponent missing from standings counts as last
    assert mart[(2, 9)].quality_win_loss_score == 0.0
    assert mart[(2, 9)].sum_opponent_points_beaten is None       # opponent has no standing
