"""Parsing and normalisation on hand-made response bodies."""

import datetime as d

import json

from pyspark.sql import functions as F

from courtline.sources import ingest as I

RESP = "request_type string, content_type string, body string"
ROUND_FIELDS = ["No", "NoTournament", "Code", "Name", "Bracket", "Phase", "StartDate", "EndDate",
                "RankMethod"]


def _rows(df, drop=("payload", "ingested_at")):
    return [r.asDict() for r in df.drop(*drop).orderBy(df.columns[0]).collect()]


def test_json_shapes(spark):
    bodies = [("a", "json", '[{"no": 1}, 5, {"no": 2}]'),
              ("b", "json", '{"data": [{"no": 3}]}'),
              ("c", "json", '{"data": {"no": 4}}'),
              ("d", "json", '{"count": 1, "items": [{"no": 5}], "other": {"no": 99}}'),
              ("e", "json", 'not json'), ("f", "json", '{"data": 7}')]
    recs = I.parse_json(spark.createDataFrame(bodies, RESP))
    got = sorted((r[0], r[1]) for r in recs.select("request_type", I.safe_int(I.field(F.col("rec"), "No"))).collect())
    assert got == [("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5)]


def test_match_rules(spark):
    bodies = [
        ("m", "json", '{"data":{"no":103,"noTournament":3,"noRound":0,"roundCode":"PA","noTeamA":1,'
                      '"noTeamB":"2","matchPointsA":2,"matchPointsB":0,"durationSet1":1080,'
                      '"durationSet2":"1080","durationSet3":null,"beginDateTimeUtc":"2025-09-04T10:00:00","status":0}}'),
        ("m", "json", '{"data":[{"no":104,"noTeamA":1,"noTeamB":2,"matchPointsA":1,"matchPointsB":1,'
                      '"durationSet1":"x","noRound":19},{"no":105,"noTeamA":1,"noTeamB":2,'
                      '"matchPointsA":"x","matchPointsB":0,"durationSet1":30},'
                      '{"no":106,"noTeamA":1,"noTeamB":null,"matchPointsA":2,"matchPointsB":0}]}')]
    out = _rows(I.norm_match(I.parse_json(spark.createDataFrame(bodies, RESP)), F.lit(77)))
    by = {r["match_id"]: r for r in out}
    assert by[103]["winner_team_id"] == 1 and by[103]["round"] == "PA" and by[103]["tournament_id"] == 3
    assert by[103]["duration_minutes"] == 36 and by[103]["status"] == "0" and by[103]["score_sets"] == "2-0"
    assert by[104]["winner_team_id"] is None and by[104]["round"] == "19" and by[104]["tournament_id"] == 77
    assert by[104]["duration_minutes"] is None
    assert by[105]["winner_team_id"] is None and by[105]["duration_minutes"] == 0
    assert by[106]["winner_team_id"] is None   # a missing team means no winner


def test_xml_rounds(spark):
    xml = [("r", "text/xml", '<Responses xmlns:v="urn:x"><BeachRounds NbItems="2"><BeachRound No="335652" '
                             'NoTournament="2" Code="I" Name="" RankMethod="&lt;DirectElimination /&gt;" />'
                             '<v:BeachRound No="2" Code="PA"><Name>Pool A</Name></v:BeachRound></BeachRounds></Responses>'),
           ("r", "text/xml", '<Responses><BeachRound No="9" Code="F" StartDate="2024-1-5"/></Responses>'),
           ("r", "text/xml", '<NoData/>'), ("r", "text/xml", '<broken')]
    out = _rows(I.norm_round(I.parse_xml(spark.createDataFrame(xml, RESP), "BeachRound", ROUND_FIELDS)))
    assert [r["round_id"] for r in out] == [2, 9, 335652]
    assert out[0]["name"] == "Pool A" and out[2]["name"] is None
    assert out[2]["rank_method"] == "<DirectElimination />"
    assert out[1]["start_date"] == d.date(2024, 1, 5)


def test_player_rules(spark):
    body = ('{"data":[{"no":1,"firstName":"","lastName":"","fullName":"Full N","height":1830000,'
            '"federationCode":" BRA ","birthdate":"2002-01-19"},{"no":"2","firstName":"A","lastName":"B",'
            '"height":"","gender":0},{"no":3,"height":700,"firstName":"C"},{"no":4,"height":183,"birthDate":"2024"}]}')
    out = _rows(I.norm_player(I.parse_json(spark.createDataFrame([("p", "json", body)], RESP))))
    assert [r["height_cm"] for r in out] == [183, None, None, 183]
    assert [r["full_name"] for r in out] == ["Full N", "A B", "C", None]
    assert out[0]["country_code"] == "BRA" and out[1]["gender"] == "0" and out[3]["birth_date"] is None


def test_tournament_city(spark):
    body = ('{"data":[{"no":2,"name":"Acapulco","type":35,"endDateMainDraw":"2025-09-08","gender":0},'
            '{"no":3,"name":"Open"},{"no":4,"name":"Rio de Janeiro"},{"no":5,"name":"  Berlin ","city":"Hamburg"},'
            '{"no":6,"name":"  Berlin "}]}')
    out = _rows(I.norm_tournament(I.parse_json(spark.createDataFrame([("t", "json", body)], RESP))))
    assert [r["city"] for r in out] == ["Acapulco", None, None, "Hamburg", "Berlin"]
    assert out[0]["tier"] == "35" and out[0]["gender"] == "0" and out[0]["end_date"] == d.date(2025, 9, 8)


def test_result_fallbacks(spark):
    xml = ('<Responses><BeachTournamentRanking><Team Rank="1" NoTeam="10" EarnedPointsTeam="0" Points="5" '
           'EarningsTotalTeam="" PrizeMoney="100"/><Team Position="2" NoTeam="11" EarnedPointsTeam="" Points="7"/>'
           '</BeachTournamentRanking></Responses>')
    df = spark.createDataFrame([("r", "text/xml", xml)], RESP)
    recs = I.parse_xml(df, "Team", ["Rank", "Position", "NoTeam", "EarnedPointsTeam", "Points",
                                    "EarningsTotalTeam", "PrizeMoney"])
    out = _rows(I.norm_result(recs, F.lit(9)))
    assert [(r["finishing_pos"], r["points"], r["prize_money"]) for r in out] == [(1, 0, 100.0), (2, 7, None)]
    # JSON number 0 falls through, text '0' does not
    body = '{"data":[{"rank":1,"noTeam":10,"earnedPointsTeam":0,"points":5},{"rank":"1","noTeam":11,"earnedPointsTeam":"0","points":5}]}'
    out = _rows(I.norm_result(I.parse_json(spark.createDataFrame([("r", "json", body)], RESP)), F.lit(9)))
    assert [r["points"] for r in out] == [5, 0]


def test_usable_drops_errors(spark):
    body = '{"data":[{"no":1},{"no":2,"errors":"x"},{"name":"no id"}]}'
    recs = I.usable(I.parse_json(spark.createDataFrame([("p", "json", body)], RESP)), ["No"])
    assert recs.count() == 1


def _records(spark, body, node="BeachMatch", kind="text/xml"):
    df = spark.createDataFrame([("r", kind, body)], RESP)
    recs = I.parse_responses(df, node)
    return [json.loads(r.j) for r in recs.select(F.to_json("rec").alias("j")).collect()]


def test_xml_at_any_depth_with_all_fields(spark):
    inner = ('<BeachMatch No="1" Odd=\'a "b"\' Both="attr"><Both>child</Both><Kept> t </Kept><Deep><In>1</In></Deep>'
             '<Errors>bad</Errors><C><![CDATA[x < y]]></C></BeachMatch><BeachMatch No="2"/><BeachMatchX No="3"/>')
    want = [{"No": "1", "Odd": 'a "b"', "Both": "child", "Kept": "t", "Errors": "bad", "C": "x < y"}, {"No": "2"}]
    for body in (f"<R>{inner}</R>", f"<R><Outer><Other><BeachMatchs>{inner}</BeachMatchs></Other></Outer></R>",
                 f'<v:R xmlns:v="urn:x"><!-- <BeachMatch No="9"/> -->{inner}</v:R>'):
        assert _records(spark, body) == want
    assert _records(spark, "<R><BeachMatch> free </BeachMatch></R>") == [{"_text": "free"}]
    assert _records(spark, f"<R>{inner}") == []
    df = spark.createDataFrame([("r", "text/xml", f"<R>{inner}</R>")], RESP)
    assert I.usable(I.parse_xml(df, "BeachMatch")).count() == 1          # the first carries Errors


def test_json_repeated_key_keeps_the_last(spark):
    assert _records(spark, '{"data":[{"no":1,"no":2}]}', kind="json") == [{"no": 2}]


def test_long_keys_are_kept_whole(spark):
    key = "k" * 40_000
    df = spark.createDataFrame([("r", "json", json.dumps([{key: 1}]))], RESP)
    assert I.parse_json(df).select(F.map_keys(I.pascal_keys(F.col("rec")))[0]).first()[0] == "K" + key[1:]


def test_results_and_matches_that_are_dropped(spark):
    def left(rule, *records):
        df = spark.createDataFrame([("r", "json", json.dumps(list(records)))], RESP)
        return rule(I.parse_json(df)).count()
    assert left(I.usable_results, {"rank": 1, "noTeam": 5}, {"position": 2, "noTeam": "6"}, {"noTeam": 7}, {"rank": 1, "noTeam": "x"},
                {"rank": 1, "noTeam": 8, "errors": "e"}) == 2
    assert left(I.usable_matches, {"no": 1, "noTournament": 2}, {"no": 1}, {"noTournament": 3}, {"no": "a", "noTournament": 2}) == 1


def test_payload_is_canonical(spark):
    """Records that say the same give the same text, whatever their order, blanks and key case."""
    same = ['[ {"no": 1, "name": "é \\"x\\"", "inner": {"b": [1, {"z": null, "a": 2}], "a": 1.50}, "empty": "", "none": null} ]',
            '[{"None":null,"Empty":"","Inner":{"a":1.5,"b":[1,{"a":2,"z":null}]},"Name":"\\u00e9 \\"x\\"","No":1}]',
            '{"data": {"none":null, "name":"é \\"x\\"","inner": {"a": 1.5, "b": [1, {"z": null, "a": 2}]}, "empty": "", "No": 1}}']
    want = '{"Empty":"","Inner":{"a":1.5,"b":[1,{"a":2,"z":null}]},"Name":"é \\"x\\"","No":1,"None":null}'
    rows = spark.createDataFrame([(b,) for b in [*same, '{"data": {"no": 1, "No": 2}}', '{"data": [{}]}']], "body string")
    got = [r.payload for r in I.parse_json(rows).select(I.payload_text(F.col("rec")).alias("payload")).collect()]
    assert sorted(got) == sorted([want] * 3 + ['{"No":2}', "{}"])       # of both forms the PascalCase one counts
    xml = spark.createDataFrame([('<r><T No="1" Name=""><Code> c </Code></T></r>',), ('<r><T Name="" No="1" Code="c"/></r>',)], "body string")
    got = [r.payload for r in I.parse_xml(xml, "T").select(I.payload_text(F.col("rec")).alias("payload")).collect()]
    assert got == ['{"Code":"c","Name":"","No":"1"}'] * 2


def test_payload_reads_the_record_once(spark):
    """The key rules ask for the record's map at every key; it is bound, not named again."""
    x = spark.range(1).select(F.try_parse_json(F.lit('{"no": 1, "No": 2, "b": {"z": 1, "a": null}}')).alias("rec"))
    out = x.select(I.payload_text(F.col("rec")).alias("p"))
    assert out.first().p == '{"B":{"a":null,"z":1},"No":2}'
    assert out._jdf.queryExecution().analyzed().toString().count("try_variant_get(rec") == 1
    recs = spark.createDataFrame([('{"no": "7", "noTournament": 3}',), ('{"No": 1.0, "noTournament": "x"}',), ('{"no": null, "noTournament": 3}',)],
                                 "j string").select(F.try_parse_json("j").alias("rec"))
    assert I.usable_matches(recs).count() == 1
