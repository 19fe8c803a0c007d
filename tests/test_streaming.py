"""Structured Streaming ingest: files -> parse -> normalise -> upsert into a versioned table."""

import json
import os
import tempfile

import pytest

from courtline.sources.ingest import norm_team
from courtline.streaming.ingest_stream import committed, read_latest, start_ingest, upsert_batch

FIELDS = ["No", "NoTournament", "NoPlayer1", "NoPlayer2", "CountryCode", "Status", "ValidFrom", "ValidTo"]


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def _normalise(recs):
    return norm_team(recs, carry=["seq"]).drop("payload")


def _run(spark, src, table, ck):
    q = start_ingest(spark, src, table, ck, "BeachTeam", FIELDS, _normalise, ["team_id"],
                     required=["No"])
    q.awaitTermination()


def test_stream_upsert(spark):
    root = tempfile.mkdtemp(prefix="courtline-stream-")   # local test folder
    src, table, ck = (os.path.join(root, p) for p in ("in", "table", "ck"))
    os.makedirs(src)
    _write(src, "a.json", [
        {"request_type": "team", "content_type": "json", "seq": 1,
         "body": '{"data":[{"no":1,"noTournament":10,"noPlayer1":5,"noPlayer2":6},'
                 '{"no":2,"noTournament":10,"noPlayer1":7,"noPlayer2":8}]}'}])
    _run(spark, src, table, ck)
    assert {r.team_id: r.player_a_id for r in read_latest(spark, table).collect()} == {1: 5, 2: 7}
    _write(src, "b.json", [
        {"request_type": "team", "content_type": "text/xml", "seq": 2,
         "body": '<Responses><BeachTeam No="2" NoTournament="10" NoPlayer1="70" NoPlayer2="8"/></Responses>'}])
    _run(spark, src, table, ck)
    assert {r.team_id: r.player_a_id for r in read_latest(spark, table).collect()} == {1: 5, 2: 70}


def test_replayed_batch_writes_the_same_rows(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="courtline-stream-"), "table")
    rows = lambda *r: spark.createDataFrame(list(r), "team_id long, v long, seq long")
    upsert_batch(spark, rows((1, 1, 1), (2, 1, 1)), table, 0, ["team_id"], "seq")
    for _ in range(2):
        upsert_batch(spark, rows((2, 2, 2)), table, 1, ["team_id"], "seq")
        assert {r.team_id: r.v for r in read_latest(spark, table).collect()} == {1: 1, 2: 2}
    # a version whose write did not end is not read
    os.makedirs(os.path.join(table, "version=7"))
    assert committed(spark, table) == [0, 1] and read_latest(spark, table).count() == 2
    assert read_latest(spark, table + "-none") is None


def test_failing_read_is_raised(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="courtline-stream-"), "table")
    upsert_batch(spark, spark.createDataFrame([(1, 1, 1)], "team_id long, v long, seq long"), table, 0, ["team_id"], "seq")
    for f in os.listdir(os.path.join(table, "version=0")):
        if f.endswith(".parquet"):
            with open(os.path.join(table, "version=0", f), "wb") as out:
                out.write(b"broken")
    with pytest.raises(Exception):
        read_latest(spark, table)
