"""Ingest-side queries over the driver's tables.

Response bodies are built from table rows with string concatenation (the
oracle builds the same text), then parsed and normalised by the library; the
expected values come from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.league import League
from courtline.registry_store import league
from courtline.operators import preview, upsert as up
from courtline.sources import ingest as ing
from courtline.sources.sinks import csv_roundtrip, export_json, scratch_path, write_table
from courtline.sources.tables import read_table

# Fixed parameters of the registered ingest queries.
AS_OF = "2001-09-01 00:00:00"          # the "now" of the fixture
EARLIER = "2001-08-01 00:00:00"        # when marks were set before
UPSERT_AT = "2024-12-31 00:00:00"
FIXTURE_MIN_YEAR = 1998                 # fixture years are 1995-2001
SOURCE_SEASONS = ("1997", "1998-99", "2001")
EVENT_RANGE = ("2024-01-01", "2024-01-31")
PREVIEW_LIMIT = 10_000
SAMPLE_LIMIT = 10
LINES_PER_ORDER = 2


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _lit_ts(s: str) -> Column:
    return F.lit(s).cast("timestamp")


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    target = up.last_wins(e.filter(F.col("event_id") % 2 == 0), ["user_id"], ["event_id"]) \
        .withColumn("ingested_at", F.col("ts").cast("timestamp"))
    batch = e.filter(F.col("event_id") % 2 == 1)
    return up.upsert(target, batch, ["user_id"], "event_id", _lit_ts(UPSERT_AT))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return league(spark, sf_dir).raw["results"]


def phase_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _results(spark, sf_dir)
    pos = F.col("finishing_pos")
    phases = {
        "none": r,
        "MainDraw": r.filter(pos <= 8).withColumn("points", F.col("points") + 1000),
        "Qualification": r.filter((pos > 4) & (pos <= 12)).withColumn("points", F.col("points") + 2000),
    }
    return up.phase_merge(phases, ["tournament_id", "team_id"])


def snapshot_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rk = league(spark, sf_dir).raw["team_rankings"]
    fetched = rk.withColumnRenamed("snapshot_date", "fetched_on")
    return up.snapshot_stamp(fetched, F.date_add("fetched_on", 1))


def expand_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = league(spark, sf_dir).raw["tournaments"]
    return up.expand_set(t, F.to_date(_lit_ts(AS_OF)), FIXTURE_MIN_YEAR)


def _ingest_times(lg: League) -> tuple[DataFrame, DataFrame]:
    """Fixture ingest times: results and rounds loaded some days after the event."""
    tid = F.col("tournament_id")
    y, m = F.floor(tid / 1000).cast("int"), (F.floor(tid / 10) % 100).cast("int")
    res = lg.raw["results"].withColumn(
        "ingested_at", F.date_add(F.make_date(y, m, F.lit(1)), (F.col("team_id") % 400).cast("int"))
        .cast("timestamp"))
    rnd = lg.raw["rounds"].withColumn(
        "ingested_at", F.date_add(F.col("start_date"), (F.col("round_id") % 500).cast("int"))
        .cast("timestamp"))
    return res, rnd


def _checked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tournaments asked for: every (ship month, parity) of the line items."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(((F.year("l_shipdate") * 100 + F.month("l_shipdate")) * 10
                      + F.col("l_orderkey") % 2).cast("long").alias("tournament_id")).distinct()


def empty_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    return up.empty_checks(_checked_ids(spark, sf_dir), lg.raw["results"], lg.raw["rounds"],
                           _lit_ts(AS_OF))


def ingest_skip_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = league(spark, sf_dir)
    res, rnd = _ingest_times(lg)
    checks = up.empty_checks(_checked_ids(spark, sf_dir), lg.raw["results"], lg.raw["rounds"],
                             _lit_ts(AS_OF))
    skip = up.skip_set(lg.raw["tournaments"], res, rnd, checks, _lit_ts(AS_OF))
    cand = up.expand_set(lg.raw["tournaments"], F.to_date(_lit_ts(AS_OF)), FIXTURE_MIN_YEAR)
    load = up.to_load(cand, skip).select("tournament_id", F.lit(True).alias("load"))
    return (cand.select("tournament_id")
            .join(skip.withColumn("skip", F.lit(True)), "tournament_id", "left")
            .join(load, "tournament_id", "left")
            .select("tournament_id", F.coalesce("skip", F.lit(False)).alias("skip"),
                    F.coalesce("load", F.lit(False)).alias("load")))


def source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = league(spark, sf_dir).raw["tournaments"]
    return up.source_filter_tournaments(t, SOURCE_SEASONS)


def source_filter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = league(spark, sf_dir).raw["events"]
    return up.source_filter_events(e, EVENT_RANGE[0], EVENT_RANGE[1])


def rows_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return preview.rows_capped(li, ["l_orderkey"], order, LINES_PER_ORDER)


def head_tail_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview.head_tail_sample(o, ["o_orderkey"], SAMPLE_LIMIT)


def typed_filter_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    filters = [("o_orderpriority", "urgent"), ("o_totalprice", (1000, 100000)),
               ("o_orderdate", ("1996-01-01", "1997-12-31"))]
    return preview.typed_filter(o, filters, PREVIEW_LIMIT, order=["o_orderkey"])


def _json_bodies(e: DataFrame) -> DataFrame:
    p = F.col("props")
    shape = F.col("event_id") % 4
    body = (F.when(F.col("event_type") == "error", F.lit("not json"))
            # a repeated key: the last value counts
            .when(shape == 0, F.concat(F.lit('[{"k": -1, '), F.substr(p, F.lit(2)), F.lit("]")))
            .when(shape == 1, F.concat(F.lit('{"data": ['), p, F.lit(", "), p, F.lit("]}")))
            .when(shape == 2, F.concat(F.lit('{"meta": 1, "data": '), p, F.lit("}")))
            .otherwise(F.concat(F.lit('{"count": 1, "items": ['), p, F.lit("]}"))))
    return e.select("event_id", F.lit("application/json").alias("content_type"), body.alias("body"))


def parse_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = ing.parse_json(_json_bodies(read_table(spark, sf_dir, "events")))
    return recs.select("event_id",
                       F.array_join(F.array_sort(F.map_keys(ing.pascal_keys(F.col("rec")))), ",")
                       .alias("keys"),
                       ing.safe_int(ing.field(F.col("rec"), "K")).alias("k"), F.to_json("rec").alias("payload"))


def _xml_bodies(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    item = F.concat(F.lit('<x:BeachMatch No="'), _s(k), F.lit('" Other="u" Status="'), F.col("o_orderstatus"),
                    F.lit('" Name="A &amp; B &lt;'), _s(F.col("o_custkey")), F.lit('&gt;"><Priority>'),
                    F.col("o_orderpriority"), F.lit("</Priority><Empty></Empty><More> m </More></x:BeachMatch>"))
    plain = F.regexp_replace(item, "x:", "")
    body = (F.when(k % 5 == 0, F.lit("<Responses><BeachMatch No=\"1\"")).when(
        k % 2 == 0, F.concat(F.lit('<Responses xmlns:x="urn:v"><BeachMatchs NbItems="1">'), item,
                             F.lit("</BeachMatchs></Responses>")))
            .when(k % 3 == 0, F.concat(F.lit("<Responses><Outer><Inner><BeachMatchs>"), plain, F.lit("</BeachMatchs></Inner></Outer></Responses>")))
            .otherwise(F.concat(F.lit("<Responses>"), plain, F.lit("</Responses>"))))
    return o.select("o_orderkey", F.lit("text/xml").alias("content_type"), body.alias("body"))


def parse_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    recs = ing.parse_xml(_xml_bodies(o), "BeachMatch")

    def r(name):
        return ing.field(F.col("rec"), name)
    return recs.select("o_orderkey", ing.safe_int(r("No")).alias("match_id"),
                       ing.text(r("Status")).alias("status"), ing.text(r("Name")).alias("name"),
                       ing.text(r("Priority")).alias("priority"), ing.text(r("Empty")).alias("empty"), F.to_json("rec").alias("payload"))


def _num(c: Column) -> Column:
    return F.coalesce(_s(c), F.lit("null"))


def _quoted(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), _s(c), F.lit('"')))


def match_bodies(m: DataFrame) -> DataFrame:
    """JSON match records (camelCase) from fixture matches, in both body shapes."""
    mid = F.col("match_id")
    w, t1, t2 = F.col("winner_team_id"), F.col("team1_id"), F.col("team2_id")
    pa = F.when(w == t1, 2).when(w == t2, 0).otherwise(1)
    pb = F.when(w == t1, 0).when(w == t2, 2).otherwise(1)
    rec = F.concat(
        F.lit('{"no": '), _s(mid), F.lit(', "noTournament": '), _s(F.col("tournament_id")),
        F.lit(', "noRound": '), F.when(mid % 3 == 0, F.lit("0")).otherwise(F.lit('""')),
        F.lit(', "roundCode": '), _quoted(F.col("round")),
        F.lit(', "noTeamA": '), _num(t1), F.lit(', "noTeamB": '), _quoted(t2),
        F.lit(', "matchPointsA": '), _s(pa), F.lit(', "matchPointsB": "'), _s(pb), F.lit('"'),
        F.lit(', "durationSet1": '), _s(mid % 900), F.lit(', "durationSet2": "'), _s(mid % 700),
        F.lit('", "durationSet3": '), F.when(mid % 4 == 0, F.lit('"x"')).otherwise(F.lit("null")),
        F.lit(', "beginDateTimeUtc": '), _quoted(F.date_format("played_at", "yyyy-MM-dd HH:mm:ss")),
        F.lit(', "status": '), _s(mid % 3), F.lit("}"))
    body = F.when(mid % 2 == 0, F.concat(F.lit('{"data": '), rec, F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"data": ['), rec, F.lit("]}")))
    return m.select(F.lit("application/json").alias("content_type"), body.alias("body"))


def norm_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = league(spark, sf_dir).raw["matches"]
    recs = ing.usable_matches(ing.parse_json(match_bodies(m)))
    return ing.norm_match(recs, ingested_at=_lit_ts(UPSERT_AT))


def player_bodies(c: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    first = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("F"), _s(k)))
    h = F.when(k % 4 == 0, F.lit('""')).when(k % 4 == 1, _s(1000000 + k * 10000)) \
        .when(k % 4 == 2, _s(150 + k % 60)).otherwise(F.concat(F.lit('"'), _s(k % 900), F.lit('"')))
    rec = F.concat(
        F.lit('{"no": '), F.when(k % 2 == 0, _s(k)).otherwise(F.concat(F.lit('"'), _s(k), F.lit('"'))),
        F.lit(', "firstName": "'), first, F.lit('", "lastName": "'), F.col("c_mktsegment"),
        F.lit('", "fullName": "'), F.col("c_name"), F.lit('", "height": '), h,
        F.lit(', "gender": '), _s(k % 2), F.lit(', "federationCode": " N'), _s(F.col("c_nationkey")),
        F.lit(' ", "birthdate": "'), _s(1950 + k % 50), F.lit("-"), _s(1 + k % 12), F.lit("-"),
        _s(1 + k % 28), F.lit('"}'))
    return c.select(F.lit("json").alias("content_type"),
                    F.concat(F.lit('{"data": ['), rec, F.lit("]}")).alias("body"))


def norm_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = ing.usable(ing.parse_json(player_bodies(read_table(spark, sf_dir, "customer"))), ["No"])
    return ing.norm_player(recs, _lit_ts(UPSERT_AT))


def team_bodies(t: DataFrame) -> DataFrame:
    b = F.col("player_b_id")
    item = F.concat(F.lit('<BeachTeam No="'), _s(F.col("team_id")), F.lit('" NoTournament="'),
                    _s(F.col("tournament_id")), F.lit('" NoPlayer1="'), _s(F.col("player_a_id")),
                    F.lit('" NoPlayer2="'), F.coalesce(_s(b), F.lit("")), F.lit('" CountryCode="'),
                    F.col("country_code"), F.lit('" Status="'), _s(F.col("team_id") % 3),
                    F.lit('"><ValidFrom>2001-1-5</ValidFrom></BeachTeam>'))
    return t.select(F.lit("text/xml").alias("content_type"),
                    F.concat(F.lit("<Responses><BeachTeams>"), item,
                             F.lit("</BeachTeams></Responses>")).alias("body"))


def norm_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = league(spark, sf_dir).raw["teams"]
    recs = ing.parse_xml(team_bodies(t), "BeachTeam")
    return ing.norm_team(recs, _lit_ts(UPSERT_AT)).filter(
        F.col("team_id").isNotNull() & F.col("tournament_id").isNotNull())


def _json_q(c: Column) -> Column:
    """A JSON string literal of a column (NULL -> null)."""
    return _quoted(c)


def event_bodies(e: DataFrame) -> DataFrame:
    k = F.col("event_id")
    beach = (F.when(k % 4 == 0, F.lit('"1"')).when(k % 4 == 1, F.lit("true"))
             .when(k % 4 == 2, F.lit('"yes "')).otherwise(F.lit("0")))
    rec = F.concat(
        F.lit('{"no": '), _s(k), F.lit(', "code": '), _json_q(F.upper("event_type")),
        F.lit(', "name": "", "startDate": '), _json_q(F.date_format("ts", "yyyy-MM-dd")),
        F.lit(', "endDate": null, "type": '), _json_q(F.col("event_type")),
        F.lit(', "noParentEvent": '), _s(F.col("user_id") % 3),
        F.lit(', "countryCode": "", "hasBeachTournament": '), beach,
        F.lit(', "hasMenTournament": "On", "hasWomenTournament": null, "isVisManaged": "false"}'))
    return e.select(F.lit("json").alias("content_type"),
                    F.concat(F.lit('{"data": {"items": 1, "row": '), rec, F.lit("}}")).alias("body"))


def norm_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = event_bodies(read_table(spark, sf_dir, "events"))
    # the records sit one level down: {"data": {"items": 1, "row": {...}}} -> data is the object
    recs = ing.parse_json(bodies).select(ing.field(F.col("rec"), "Row").alias("rec"))
    return ing.norm_event(recs, _lit_ts(UPSERT_AT))


def tournament_bodies(t: DataFrame) -> DataFrame:
    m = F.col("m")
    name = F.when(m % 3 == 0, F.concat(F.lit("C"), _s(m))).otherwise(F.col("name"))
    rec = F.concat(
        F.lit('{"no": '), _s(F.col("tournament_id")), F.lit(', "name": '), _json_q(name),
        F.lit(', "season": '), _json_q(F.col("season")), F.lit(', "type": '), _s(m),
        F.lit(', "startDate": '), _json_q(_s(F.col("start_date"))),
        F.lit(', "endDateMainDraw": '), _json_q(_s(F.col("end_date"))),
        F.lit(', "endDateQualification": '), _json_q(_s(F.date_add("start_date", 3))),
        F.lit(', "countryCode": '), _json_q(F.col("country_code")),
        F.lit(', "countryName": '), _json_q(F.col("country_name")),
        F.lit(', "gender": '), _s(F.col("g")), F.lit(', "timezone": ""}'))
    return t.select(F.lit("json").alias("content_type"), F.concat(F.lit("["), rec, F.lit("]")).alias("body"))


def norm_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtline.sources.league import base, tournaments
    t = tournaments(base(spark, sf_dir))
    recs = ing.parse_json(tournament_bodies(t))
    return ing.norm_tournament(recs, _lit_ts(UPSERT_AT))


def _attr(name: str, c: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), F.coalesce(_s(c), F.lit("")), F.lit('"'))


def result_bodies(r: DataFrame) -> DataFrame:
    item = F.concat(F.lit("<BeachTeamRanking"), _attr("Rank", F.col("finishing_pos")),
                    _attr("NoTeam", F.col("team_id")), _attr("EarnedPointsTeam", F.col("points")),
                    F.lit(' Points="999"'), _attr("EarningsTotalTeam", F.col("prize_money").cast("long")),
                    F.lit(' PrizeMoney="5"/>'))
    return r.select("tournament_id", F.lit("xml").alias("content_type"),
                    F.concat(F.lit("<Responses><BeachTournamentRanking>"), item,
                             F.lit("</BeachTournamentRanking></Responses>")).alias("body"))


def norm_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = league(spark, sf_dir).raw["results"]
    recs = ing.parse_xml(result_bodies(r), "BeachTeamRanking")
    return ing.norm_result(ing.usable_results(recs), F.col("tournament_id"), _lit_ts(UPSERT_AT))


def round_bodies(r: DataFrame) -> DataFrame:
    item = F.concat(F.lit("<BeachRound"), _attr("No", F.col("round_id")),
                    _attr("NoTournament", F.col("tournament_id")), _attr("Code", F.col("code")),
                    _attr("Name", F.col("name")),
                    F.when(F.col("bracket").isNull(), F.lit("")).otherwise(_attr("Bracket", F.col("bracket"))),
                    _attr("Phase", F.col("phase")), _attr("StartDate", F.col("start_date")),
                    F.lit(' RankMethod="&lt;DirectElimination /&gt;"/>'))
    return r.select(F.lit("xml").alias("content_type"),
                    F.concat(F.lit("<Responses><BeachRounds>"), item,
                             F.lit("</BeachRounds></Responses>")).alias("body"))


def norm_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = league(spark, sf_dir).raw["rounds"]
    recs = ing.parse_xml(round_bodies(r), "BeachRound")
    return ing.norm_round(recs, _lit_ts(UPSERT_AT))


def round_ranking_bodies(r: DataFrame) -> DataFrame:
    pos = F.col("finishing_pos")
    item = F.concat(F.lit("<BeachRoundRanking"), _attr("Position", pos),
                    _attr("Rank", F.when(pos % 4 == 0, F.lit(-1)).otherwise(pos)),
                    _attr("TeamFederationCode", F.concat(F.lit("N"), _s(F.col("team_id") % 6))),
                    F.lit(' TeamName=""'), _attr("MatchPoints", F.col("points")),
                    _attr("MatchesWon", 15 - pos), _attr("MatchesLost", pos - 1), F.lit("/>"))
    return r.select((F.col("tournament_id") * 10).alias("round_id"), F.lit("xml").alias("content_type"),
                    F.concat(F.lit("<Responses><BeachRoundRankings>"), item,
                             F.lit("</BeachRoundRankings></Responses>")).alias("body"))


def norm_round_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = league(spark, sf_dir).raw["results"]
    recs = ing.usable(ing.parse_xml(round_ranking_bodies(r), "BeachRoundRanking"), ["Position"])
    return ing.norm_round_ranking(recs, F.col("round_id"), _lit_ts(UPSERT_AT))


def team_ranking_bodies(rk: DataFrame) -> DataFrame:
    wt = F.col("ranking_type") == "beach_world_tour"
    rec = F.concat(
        F.lit('{"position": '), _s(F.col("position")), F.lit(', "noPlayer1": '), _s(F.col("no_player1")),
        F.lit(', "noPlayer2": "'), _s(F.col("no_player2")), F.lit('", "teamName": ""'),
        F.lit(', "earnedPointsTeam": '), F.when(wt, _s(F.col("earned_points"))).otherwise(F.lit("0")),
        F.lit(', "points": '), _s(F.col("earned_points")), F.lit("}"))
    return rk.select("ranking_type", "snapshot_date", "gender", F.lit("json").alias("content_type"),
                     F.concat(F.lit('{"data": ['), rec, F.lit("]}")).alias("body"))


def norm_team_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rk = league(spark, sf_dir).raw["team_rankings"]
    recs = ing.usable(ing.parse_json(team_ranking_bodies(rk)), ["Position"])
    return ing.norm_team_ranking(recs, F.col("ranking_type"), F.col("snapshot_date"),
                                 F.col("gender"), _lit_ts(UPSERT_AT))


def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_roundtrip(read_table(spark, sf_dir, "nation"), "nation")


def export_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return spark.read.schema(nation.schema).json(export_json(nation, name="nation"))


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.filter(F.col("o_orderkey") % 2 == 0), o.filter(F.col("o_orderkey") % 2 == 1)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes to one table, the second appending."""
    even, odd = _halves(spark, sf_dir)
    path = scratch_path(even, "append")
    write_table(even, path)
    write_table(odd, path, mode="append")
    return spark.read.parquet(path)


def table_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes to one table, the second replacing the first."""
    even, odd = _halves(spark, sf_dir)
    path = scratch_path(even, "reload")
    write_table(even, path)
    write_table(odd, path)
    return spark.read.parquet(path)


def empty_checks_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 with earlier marks: every tournament was marked empty once; the even ones are checked now."""
    lg = league(spark, sf_dir)
    ids = _checked_ids(spark, sf_dir)
    before = _lit_ts(EARLIER)
    previous = ids.select("tournament_id", before.alias("results_empty_at"), before.alias("rounds_empty_at"))
    return up.empty_checks(ids.filter(F.col("tournament_id") % 2 == 0), lg.raw["results"], lg.raw["rounds"],
                           _lit_ts(AS_OF), previous)


def registry() -> dict:
    return {f.__name__: f for f in (
        export_json_roundtrip, table_append, table_reload, empty_checks_again,
        upsert_latest, phase_merge, snapshot_stamp, expand_set, empty_checks, ingest_skip_set,
        source_filter, source_filter_events, rows_capped, head_tail_sample, typed_filter_preview, parse_json_records,
        parse_xml_records, norm_match, norm_player, norm_team, norm_event, norm_tournament,
        norm_result, norm_round, norm_round_ranking, norm_team_ranking, export_csv_roundtrip)}

