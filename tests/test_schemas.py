"""Raw tables from both paths (fixture derivation, normalisers) conform to the catalogue."""

from pyspark.sql import functions as F

from courtline.sources import ingest as I
from courtline.sources.league import raw_tables
from courtline.sources.schemas import ENTITY_FIELDS, RAW_KEYS, RAW_SCHEMAS, REQUEST_FIELDS, conforms


def test_fixture_raw_layer_conforms(spark, small_dir):
    for name, df in raw_tables(spark, small_dir).items():
        assert conforms(df.schema, name) == [], name


def test_normalisers_conform(spark):
    recs = spark.createDataFrame([("{}",)], "b string").select(F.parse_json("b").alias("rec"))
    out = {
        "events": I.norm_event(recs), "tournaments": I.norm_tournament(recs), "teams": I.norm_team(recs),
        "matches": I.norm_match(recs, F.lit(1)), "results": I.norm_result(recs, F.lit(1)),
        "players": I.norm_player(recs), "rounds": I.norm_round(recs),
        "round_rankings": I.norm_round_ranking(recs, F.lit(1)),
        "team_rankings": I.norm_team_ranking(recs, F.lit("t"), F.lit("2020-01-01"), F.lit("M")),
    }
    for table, df in out.items():
        assert conforms(df.schema, table) == [], table
        assert "payload" in df.columns and "ingested_at" in df.columns


def test_keys_and_fields_declared():
    assert set(RAW_KEYS) == set(RAW_SCHEMAS)
    for table, keys in RAW_KEYS.items():
        assert all(k in RAW_SCHEMAS[table].fieldNames() for k in keys)
    assert len(ENTITY_FIELDS) == 9


def test_request_fields():
    assert len(REQUEST_FIELDS) == 16
    assert all(len(set(f)) == len(f) and f for f in REQUEST_FIELDS.values())
    assert len(REQUEST_FIELDS["GetBeachMatch"]) == 37
