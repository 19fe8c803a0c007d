"""fct_matches ranking rules on a hand-built raw layer."""

import datetime as d

import pytest

from courtline.league import League

D = d.date(2020, 5, 10)


def _raw(spark):
    mk = spark.createDataFrame
    return {
        "players": mk([(i, None, None, f"P{i}", "M", None, 180, "X", None) for i in range(1, 9)],
                      "player_id long, first_name string, last_name string, full_name string, gender string, "
                      "birth_date date, height_cm int, country_code string, profile_url string"),
        "tournaments": mk([(1, "T1", "2020", "Open", D, D, None, "C1", "Country", "M", None, None)],
                          "tournament_id long, name string, season string, tier string, start_date date, "
                          "end_date date, city string, country_code string, country_name string, gender string, "
                          "status string, timezone string"),
        # team 1 = (1,2); team 2 = (2,1) the same pair; team 3 = (3,4); team 4 = (5, NULL)
        "teams": mk([(1, 1, 1, 2), (2, 1, 2, 1), (3, 1, 3, 4), (4, 1, 5, None)],
                    "team_id long, tournament_id long, player_a_id long, player_b_id long")
        .selectExpr("*", "'N' as country_code", "cast(null as string) as status",
                    "cast(null as date) as valid_from", "cast(null as date) as valid_to"),
        "matches": mk([(1, 1, 1, 2, 1), (2, 1, 1, 3, 1), (3, 1, 4, 3, 3), (4, 1, 3, 1, 1)],
                      "match_id long, tournament_id long, team1_id long, team2_id long, winner_team_id long")
        .selectExpr("match_id", "tournament_id", "cast(null as string) as phase", "'PA' as round", "team1_id",
                    "team2_id", "winner_team_id", "cast(null as string) as score_sets",
                    "cast(null as int) as duration_minutes", "cast(null as timestamp) as played_at",
                    "cast(null as string) as result_type", "cast(null as string) as status"),
        "results": mk([], "tournament_id long, team_id long, finishing_pos int, points int, prize_money double"),
        "rounds": mk([(10, 1, "PA", "Pool A", "Pool", None, D)],
                     "round_id long, tournament_id long, code string, name string, bracket string, phase string, "
                     "start_date date")
        .selectExpr("*", "cast(null as date) as end_date", "cast(null as string) as rank_method"),
        "team_rankings": mk([
            ("beach_world_tour", D, "M", 7, 2, 1, None, 100),      # pair (1,2), same date as the match
            ("beach_olympic", D, "M", 3, 1, 2, None, 100),         # same date, other type: olympic wins
            ("beach_world_tour", d.date(2020, 5, 11), "M", 1, 1, 2, None, 100),   # a day after: ignored
            ("beach_world_tour", d.date(2020, 1, 1), "M", 9, 4, 3, None, 100),    # pair (3,4)
            ("beach_world_tour", d.date(2020, 1, 1), "M", 5, 5, None, None, 100),  # NULL player: never matches
        ], "ranking_type string, snapshot_date date, gender string, position int, no_player1 long, "
           "no_player2 long, team_name string, earned_points int"),
    }


@pytest.mark.parametrize("method", ["fill", "range"])
def test_match_rankings(spark, method):
    lg = League(_raw(spark), asof_method=method)
    got = {r.match_id: (r.team1_ranking_position, r.team2_ranking_position, r.higher_seed_won)
           for r in lg.fct_matches.collect()}
    assert got[1] == (3, None, None)     # same pair on both sides: side 1 only
    assert got[2] == (3, 9, True)        # better-ranked team 1 won
    assert got[3] == (None, 9, None)     # team with a missing player has no ranking
    assert got[4] == (9, 3, True)        # team 2 (rank 3) beat team 1 (rank 9): better seed won
