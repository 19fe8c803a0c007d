"""Raw-layer catalogue (S8) and the fields read per entity.

One typed schema and one business key per raw table.  Spark does not enforce
keys; ``courtline.operators.quality.unique`` / ``unique_combination`` check
them (Q1, Q2, Q4).  ``payload`` (the record as JSON text) and
``ingested_at`` are added by the normalisers.
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
_TS, _B, _F = T.TimestampType(), T.BooleanType(), T.DoubleType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "players": _schema(("player_id", _L), ("first_name", _S), ("last_name", _S), ("full_name", _S),
                       ("gender", _S), ("birth_date", _D), ("height_cm", _I), ("country_code", _S),
                       ("profile_url", _S)),
    "teams": _schema(("team_id", _L), ("tournament_id", _L), ("player_a_id", _L),
                     ("player_b_id", _L), ("country_code", _S), ("status", _S),
                     ("valid_from", _D), ("valid_to", _D)),
    "tournaments": _schema(("tournament_id", _L), ("name", _S), ("season", _S), ("tier", _S),
                           ("start_date", _D), ("end_date", _D), ("city", _S),
                           ("country_code", _S), ("country_name", _S), ("gender", _S),
                           ("status", _S), ("timezone", _S)),
    "matches": _schema(("match_id", _L), ("tournament_id", _L), ("phase", _S), ("round", _S),
                       ("team1_id", _L), ("team2_id", _L), ("winner_team_id", _L),
                       ("score_sets", _S), ("duration_minutes", _I), ("played_at", _TS),
                       ("result_type", _S), ("status", _S)),
    "results": _schema(("tournament_id", _L), ("team_id", _L), ("finishing_pos", _I),
                       ("points", _I), ("prize_money", _F)),
    "events": _schema(("event_id", _L), ("code", _S), ("name", _S), ("start_date", _D),
                      ("end_date", _D), ("type", _S), ("no_parent_event", _L),
                      ("country_code", _S), ("has_beach_tournament", _B),
                      ("has_men_tournament", _B), ("has_women_tournament", _B),
                      ("is_vis_managed", _B)),
    "rounds": _schema(("round_id", _L), ("tournament_id", _L), ("code", _S), ("name", _S),
                      ("bracket", _S), ("phase", _S), ("start_date", _D), ("end_date", _D),
                      ("rank_method", _S)),
    "team_rankings": _schema(("ranking_type", _S), ("snapshot_date", _D), ("gender", _S),
                             ("position", _I), ("no_player1", _L), ("no_player2", _L),
                             ("team_name", _S), ("earned_points", _I)),
    "round_rankings": _schema(("round_id", _L), ("position", _I), ("rank", _I),
                              ("team_federation_code", _S), ("team_name", _S),
                              ("match_points", _I), ("matches_won", _I), ("matches_lost", _I)),
    "empty_checks": _schema(("tournament_id", _L), ("results_empty_at", _TS),
                            ("rounds_empty_at", _TS)),
}

# Fixed business keys of the raw tables.
RAW_KEYS: dict[str, tuple[str, ...]] = {
    "players": ("player_id",),
    "teams": ("team_id",),
    "tournaments": ("tournament_id",),
    "matches": ("match_id",),
    "results": ("tournament_id", "team_id"),
    "events": ("event_id",),
    "rounds": ("round_id",),
    "team_rankings": ("ranking_type", "snapshot_date", "gender", "position"),
    "round_rankings": ("round_id", "position"),
    "empty_checks": ("tournament_id",),
}

# Fixed fields each normaliser reads (PascalCase), i.e. the XML element fields.
ENTITY_FIELDS: dict[str, tuple[str, ...]] = {
    "event": ("No", "Code", "Name", "StartDate", "EndDate", "Type", "NoParentEvent", "CountryCode",
              "HasBeachTournament", "HasMenTournament", "HasWomenTournament", "IsVisManaged"),
    "tournament": ("No", "Name", "Season", "Type", "StartDate", "EndDate", "EndDateMainDraw",
                   "EndDateQualification", "City", "CountryCode", "CountryName", "Gender", "Status",
                   "Timezone"),
    "team": ("No", "NoTournament", "NoPlayer1", "NoPlayer2", "CountryCode", "Status", "ValidFrom",
             "ValidTo"),
    "match": ("No", "NoTournament", "Phase", "NoRound", "RoundCode", "NoTeamA", "NoTeamB",
              "MatchPointsA", "MatchPointsB", "DurationSet1", "DurationSet2", "DurationSet3",
              "BeginDateTimeUtc", "DateTimeLocal", "ResultType", "Status"),
    "result": ("Rank", "Position", "NoTeam", "EarnedPointsTeam", "Points", "EarningsTotalTeam",
               "PrizeMoney"),
    "player": ("No", "FirstName", "LastName", "FullName", "Gender", "BirthDate", "Birthdate",
               "Height", "FederationCode"),
    "round": ("No", "NoTournament", "Code", "Name", "Bracket", "Phase", "StartDate", "EndDate",
              "RankMethod"),
    "round_ranking": ("Position", "Rank", "TeamFederationCode", "TeamName", "MatchPoints",
                      "MatchesWon", "MatchesLost"),
    "team_ranking": ("Position", "NoPlayer1", "NoPlayer2", "TeamName", "EarnedPointsTeam",
                     "Points"),
}


def conforms(df_schema: T.StructType, table: str) -> list[str]:
    """Differences between a DataFrame schema and the declared raw schema (empty = conforms)."""
    want = {f.name: f.dataType for f in RAW_SCHEMAS[table].fields}
    have = {f.name: f.dataType for f in df_schema.fields if f.name not in ("payload", "ingested_at")}
    out = [f"missing {n}" for n in want if n not in have]
    out += [f"extra {n}" for n in have if n not in want]
    out += [f"{n}: {have[n].simpleString()} != {want[n].simpleString()}"
            for n in want if n in have and have[n] != want[n]]
    return out


# The fields that each request type asks for.
REQUEST_FIELDS: dict[str, tuple[str, ...]] = {name: tuple(fields.split()) for name, fields in {
    "GetBeachTournamentList": "No Name Code CountryCode CountryName City StartDate EndDate Season Gender Type Status Timezone "
                              "NoEvent Title Version StartDateMainDraw EndDateMainDraw StartDateQualification EndDateQualification "
                              "NbTeamsMainDraw NbTeamsQualification NbTeamsFromQualification",
    "GetBeachTournament": "No Name Code CountryCode City StartDate EndDate Season Gender Type Status Timezone "
                          "NoEvent Title Version StartDateMainDraw EndDateMainDraw StartDateQualification EndDateQualification "
                          "NbTeamsMainDraw NbTeamsQualification",
    **dict.fromkeys(("GetBeachMatchList", "GetBeachMatch"),
                    "No NoTournament NoRound NoTeamA NoTeamB NoInTournament MatchPointsA MatchPointsB "
                    "DateTimeLocal LocalDate LocalTime ResultType Status Phase "
                    "NoPlayerA1 NoPlayerA2 NoPlayerB1 NoPlayerB2 TeamAName TeamBName "
                    "PointsTeamASet1 PointsTeamASet2 PointsTeamASet3 PointsTeamBSet1 PointsTeamBSet2 PointsTeamBSet3 "
                    "DurationSet1 DurationSet2 DurationSet3 Court RoundCode RoundName TournamentCode TournamentName "
                    "WinnerRank LoserRank BeginDateTimeUtc"),
    "GetBeachTeamList": "No NoTournament NoPlayer1 NoPlayer2 Name CountryCode ConfederationCode Status Rank "
                        "EarnedPointsTeam EarnedPointsPlayer PositionInMainDraw PositionInQualification "
                        "IsInMainDraw IsInQualification TournamentName TournamentTitle TournamentType ValidFrom ValidTo",
    "GetBeachTeam": "No NoTournament NoPlayer1 NoPlayer2 Name CountryCode ConfederationCode Status Rank "
                    "EarnedPointsTeam EarnedPointsPlayer PositionInMainDraw PositionInQualification "
                    "IsInMainDraw IsInQualification TournamentName TournamentTitle ValidFrom ValidTo",
    "GetBeachTournamentRanking": "Rank Position NoTeam TeamName TeamFederationCode EarnedPointsTeam EarningsTotalTeam",
    **dict.fromkeys(("GetBeachRoundList", "GetBeachRound"),
                    "No NoTournament NoInTournament Code Name Bracket Phase StartDate EndDate Version RankMethod"),
    "GetBeachRoundRanking": "Position Rank TeamFederationCode TeamName MatchPoints MatchesWon MatchesLost",
    "GetBeachWorldTourRanking": "Position Rank TeamName TeamFederationCode NbParticipations "
                                "EarnedPointsTeam EarnedPointsPlayer EarningsTotalTeam EarningsTeam EarningsPlayer "
                                "EarningsBonusTeam EarningsBonusPlayer EarningsTotalPlayer NoPlayer1 NoPlayer2 HasTournamentsRemoved",
    "GetBeachOlympicSelectionRanking": "Position TeamName TeamCountryCode NbParticipations SelectionRank Points Status "
                                       "NoPlayer1 NoPlayer2 GamesYear",
    "GetPlayer": "No FederationCode FirstName LastName Gender Nationality NationalityCode BirthDate BirthPlace Height Weight "
                 "PlaysBeach PlaysVolley TeamName CountryCode ConfederationCode ActiveBeach ActiveVolley",
    "GetPlayerList": "No FirstName LastName BirthDate BirthPlace Height Weight CountryCode Gender "
                     "FederationCode NationalityCode PlaysBeach PlaysVolley TeamName ConfederationCode",
    "GetEventList": "No Code Name StartDate EndDate Type Version NoParentEvent CountryCode HasBeachTournament HasMenTournament "
                    "HasWomenTournament IsVisManaged",
    "GetEvent": "No Code Name StartDate EndDate Type Version NoParentEvent CountryCode HasBeachTournament IsVisManaged",
}.items()}
