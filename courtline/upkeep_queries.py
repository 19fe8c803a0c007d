"""Queries over stored state: upgrades, keyed upserts, freshness and refreshed models."""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.ingest_queries import AS_OF, FIXTURE_MIN_YEAR, UPSERT_AT, _checked_ids, _ingest_times, _lit_ts
from courtline.league import League
from courtline.operators import freshness, migrate, upsert as up
from courtline.plans import refresh
from courtline.registry_store import league
from courtline.sources import keyed_table
from courtline.sources.league import TableStore
from courtline.sources.sinks import scratch_path
from courtline.sources.tables import read_table


def _upgraded(spark: SparkSession, old: DataFrame, table: str, **options) -> DataFrame:
    before, after = scratch_path(old, f"{table}-old"), scratch_path(old, f"{table}-new")
    old.write.parquet(before)
    migrate.upgrade_table(spark, before, after, table, **options)
    return spark.read.parquet(after)


def upgraded_tournaments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from before the season was text and records were kept, other columns first."""
    t = league(spark, sf_dir).raw["tournaments"].filter("season rlike '^[0-9]+$'")
    old = t.select("name", F.col("tournament_id").cast("string").alias("tournament_id"), F.col("season").cast("int").alias("season"),
                   *[c for c in t.columns if c not in ("tournament_id", "name", "season", "timezone")], F.lit(1).alias("load_no"))
    return _upgraded(spark, old, "tournaments", dropped=["load_no"], defaults={"timezone": F.lit("UTC"), "ingested_at": _lit_ts(UPSERT_AT)})


def upgraded_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that were text, times that were dates' text, a new status column."""
    m = league(spark, sf_dir).raw["matches"]
    text = ("team1_id", "duration_minutes")
    old = m.select(*[F.col(c).cast("string").alias(c) if c in text else F.col(c) for c in reversed(m.columns) if c != "status"])
    return _upgraded(spark, old, "matches")


def _loads(e: DataFrame) -> list[DataFrame]:
    """The events in three loads."""
    k = F.col("event_id") % 4
    return [e.filter((k == 0) | (k == 2)), e.filter(k == 1), e.filter(k == 3)]


def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads into a keyed table, the second one sent twice."""
    e = read_table(spark, sf_dir, "events")
    base = scratch_path(e, "keyed-users")
    first, second, third = _loads(e)
    for version, load in ((1, first), (2, second), (2, second), (3, third)):
        keyed_table.upsert_stored(spark, base, load, version, ["user_id"], "event_id", F.timestamp_add("DAY", F.lit(version), _lit_ts(AS_OF)))
    keyed_table.vacuum(spark, base, keep=1)
    return keyed_table.read(spark, base)


def stored_upsert_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of some keys; only their buckets are read."""
    e = read_table(spark, sf_dir, "events")
    base = scratch_path(e, "keyed-users")
    first, second, _ = _loads(e)
    for version, load in ((1, first), (2, second)):
        keyed_table.upsert_stored(spark, base, load, version, ["user_id"], "event_id", _lit_ts(UPSERT_AT))
    return keyed_table.read_keys(spark, base, e.filter("event_type = 'purchase'").select("user_id"))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after three batches of results, rounds and checks."""
    res, rnd = _ingest_times(league(spark, sf_dir))
    ids = _checked_ids(spark, sf_dir)
    state = spark.createDataFrame([], freshness.STATE)
    for k in range(3):
        part = freshness.batch_state(res.filter(F.col("team_id") % 3 == k), rnd.filter(F.col("round_id") % 3 == k),
                                     ids.filter(F.floor(F.col("tournament_id") / 10) % 3 == k), F.timestamp_add("DAY", F.lit(k - 2), _lit_ts(AS_OF)))
        path = scratch_path(part, "freshness")
        freshness.merge(state, part).write.parquet(path)     # what a loader keeps from batch to batch
        state = spark.read.parquet(path)
    return state


def freshness_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir)


def ingest_skip_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg, state = league(spark, sf_dir), _state(spark, sf_dir)
    skip = up.skip_by_last(lg.raw["tournaments"], state.filter("last_ingested is not null"), state, _lit_ts(AS_OF))
    cand = up.expand_set(lg.raw["tournaments"], F.to_date(_lit_ts(AS_OF)), FIXTURE_MIN_YEAR)
    return cand.select("tournament_id").join(skip.withColumn("skip", F.lit(True)), "tournament_id", "left").select("tournament_id", F.coalesce("skip", F.lit(False)).alias("skip"))


def _earlier(raw) -> dict[str, DataFrame]:
    """The raw layer before the change that the refresh queries bring in: other points, missing and moved matches, other names and rankings."""
    out = dict(raw)
    tid = F.col("tournament_id")
    out["results"] = raw["results"].withColumn("finishing_pos", F.when((tid % 70 == 0) & F.col("finishing_pos").isNotNull(), F.col("finishing_pos") % 8 + 1).otherwise(F.col("finishing_pos")))
    missing = (F.floor(tid / 10) % 12 == 5) & (F.col("match_id") % 9 == 0)
    moved = F.when(F.col("match_id") % 997 == 0, F.col("winner_team_id") * 0 + F.col("team2_id")).otherwise(F.col("winner_team_id"))
    out["matches"] = raw["matches"].filter(~missing | tid.isNull()).withColumn("winner_team_id", moved)
    out["players"] = raw["players"].withColumn("country_code", F.when(F.col("player_id") % 50 == 3, "ZZ").otherwise(F.col("country_code")))
    out["team_rankings"] = raw["team_rankings"].withColumn("earned_points", F.when((F.col("position") == 4) & (F.month("snapshot_date") == 1), 0).otherwise(F.col("earned_points")))
    return out


#: Models that match rows are joined to: stored, their sizes are known and Spark broadcasts them if they are small.
JOINED_TO = ("dim_team_tournaments", "fct_tournament_standings")


def _kept(spark: SparkSession, tables: TableStore, state: str, name: str, build) -> DataFrame:
    """A model of one state of the raw layer: written once in a run if match rows are joined to it, else a plan."""
    return tables(spark, (state, name), build) if name in JOINED_TO else build()


def _refreshed(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        after = league(spark, sf_dir).raw
        before = _earlier(after)
        changed = {t: refresh.changed_keys(before[t], after[t], t) for t in ("results", "matches", "players", "team_rankings")}
        ids = refresh.concerned(before, after, changed)
        path = scratch_path(ids, "concerned")
        ids.write.parquet(path)
        tables = TableStore()
        old, new = (partial(_kept, spark, tables, state) for state in ("before", "after"))
        stored = getattr(League(before, store=old), name)
        return refresh.refresh({name: stored}, before, after, changed, spark.read.parquet(path), store=new)[name]
    run.__name__ = f"refreshed_{name}"
    return run


@cache
def registry() -> dict:
    own = (upgraded_tournaments, upgraded_matches, stored_upsert, stored_upsert_keys, freshness_state, ingest_skip_from_state)
    return {f.__name__: f for f in (*own, *map(_refreshed, refresh.MODELS))}
