"""League tables derived from the driver's TPC-H-like test tables.

The derivation rules (ids, dates, codes) are the fixture definitions of
FIXTURES.md part B; the oracle side writes the same rules in DuckDB SQL
(``courtline.oracle``).  Only players and matches grow with the scale factor:
customers become players, orders become matches, and each (month, gender) of
order dates becomes one tournament with 16 team slots.

The result of :func:`raw_tables` has the typed column catalogue of the raw
layer (``courtline.sources.schemas``), so the same model functions run on it
and on tables produced by the ingest path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtline.session import ensure_checkpoint_dir
from courtline.sources.tables import read_table

INPUT_TABLES = ("customer", "nation", "orders", "events")

# Fixed fixture parameters (FIXTURES.md part B).
TEAM_SLOTS = 16            # team index i in 0..15 per tournament
RANKED_SLOTS = 15          # ranking entries i in 0..14 per (year, quarter, gender)
RENUMBERED_CUSTKEY = 40    # this customer's player id is -41, so that teams name a player who is missing
RANKING_TYPES = (("beach_world_tour", 0), ("beach_olympic", 5))


def _slots(n: int) -> Column:
    """One row per slot index 0..n-1 (an explode, not a join)."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def _str(c: Column | int) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(n, F.col("n_nationkey") == F.col("c_nationkey"))
            .select(F.when(F.col("c_custkey") == RENUMBERED_CUSTKEY, -1 - F.col("c_custkey"))
                     .otherwise(F.col("c_custkey") + 1).alias("player_id"),
                    F.col("c_name").alias("full_name"),
                    F.col("n_name").alias("country_code"),
                    F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("W").alias("gender"),
                    F.when(F.col("c_custkey") % 11 == 0, F.lit(None))
                     .otherwise(160 + F.col("c_custkey") % 50).cast("int").alias("height_cm")))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    half = F.floor(F.col("o_custkey") / 2).cast("bigint")
    i1 = half % TEAM_SLOTS
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.to_date("o_orderdate").alias("d"),
        F.col("o_orderstatus").alias("st"),
        (F.col("o_custkey") % 2).alias("g"),
        ((F.year("o_orderdate") * 100 + F.month("o_orderdate")) * 10
         + F.col("o_custkey") % 2).cast("bigint").alias("tournament_id"),
        i1.alias("i1"),
        ((i1 + 1 + F.col("o_orderkey") % 15) % TEAM_SLOTS).alias("i2"))


def tournaments(b: DataFrame) -> DataFrame:
    t = (b.select("tournament_id", "g").distinct()
         .withColumn("y", F.floor(F.col("tournament_id") / 1000).cast("bigint"))
         .withColumn("m", F.floor(F.col("tournament_id") / 10).cast("bigint") % 100))
    y, m, g = F.col("y"), F.col("m"), F.col("g")
    return t.select(
        "tournament_id",
        F.concat(F.lit("Open "), _str(m)).alias("name"),
        F.when(y % 2 == 0, F.concat(_str(y), F.lit("-"), _str((y + 1) % 100)))
         .otherwise(_str(y)).alias("season"),
        F.when(m == 6, "World Championship").when(m == 8, "Olympic Games")
         .otherwise("Open").alias("tier"),
        F.make_date(y.cast("int"), m.cast("int"), F.lit(1)).alias("start_date"),
        F.when(m == 3, F.lit(None).cast("date"))
         .otherwise(F.make_date(y.cast("int"), m.cast("int"), F.lit(27))).alias("end_date"),
        F.concat(F.lit("C"), _str(m % 5)).alias("country_code"),
        F.when(m == 2, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Country "), _str(m % 5))).alias("country_name"),
        F.when(g == 0, "M").otherwise("W").alias("gender"),
        "y", "m", "g")


def _partner(i: Column, y: Column, g: Column) -> Column:
    return 4 * ((i + y % 3) % TEAM_SLOTS) + 2 + g + 1


def teams(t: DataFrame) -> DataFrame:
    x = t.select("tournament_id", "y", "g", _slots(TEAM_SLOTS).alias("i"))
    i, y, g = F.col("i"), F.col("y"), F.col("g")
    return x.select(
        (F.col("tournament_id") * 100 + i).alias("team_id"), "tournament_id",
        (4 * i + g + 1).cast("bigint").alias("player_a_id"),
        F.when(i == 14, F.lit(None)).otherwise(_partner(i, y, g)).cast("bigint").alias("player_b_id"),
        F.concat(F.lit("N"), _str(i % 6)).alias("country_code"),
        "i", "y", "g")


def rounds(t: DataFrame) -> DataFrame:
    x = (t.select("tournament_id", "y", "m", _slots(4).alias("k"))
         .filter(~((F.col("k") == 2) & (F.col("m") == 4))))
    k = F.col("k")

    def by_k(*vals):
        e = F.when(k == 0, vals[0])
        for j, v in enumerate(vals[1:-1], start=1):
            e = e.when(k == j, v)
        return e.otherwise(vals[-1])

    return x.select(
        (F.col("tournament_id") * 10 + k).alias("round_id"), "tournament_id",
        by_k(F.lit("PA"), F.lit("QF"), F.lit("SF"), F.lit("F")).alias("code"),
        by_k(F.lit("Pool A"), F.lit("Quarterfinals"), F.lit("Semifinals"),
             F.lit("Final")).alias("name"),
        by_k(F.lit("Pool"), F.lit(None).cast("string"), F.lit("W")).alias("bracket"),
        by_k(F.lit(None).cast("string"), F.lit("Bracket"), F.lit("Bracket"),
             F.lit("Final")).alias("phase"),
        F.make_date(F.col("y").cast("int"), F.col("m").cast("int"),
                    by_k(F.lit(1), F.lit(11), F.lit(21), F.lit(27))).alias("start_date"))


def matches(b: DataFrame) -> DataFrame:
    day = F.dayofmonth("d")
    tid = F.col("tournament_id")
    team1 = tid * 100 + F.col("i1")
    team2 = tid * 100 + F.col("i2")
    return b.select(
        "match_id", "tournament_id",
        F.lit(None).cast("string").alias("phase"),
        F.when(day <= 10, "PA").when(day <= 20, "QF").when(day <= 26, "SF")
         .otherwise("F").alias("round"),
        team1.alias("team1_id"),
        F.when(F.col("match_id") % 97 == 0, F.lit(None)).otherwise(team2).alias("team2_id"),
        F.when(F.col("st") == "F", team1).when(F.col("st") == "O", team2)
         .alias("winner_team_id"),
        F.when(F.col("match_id") % 5 == 0, F.col("d").cast("timestamp")).alias("played_at"))


def results(tm: DataFrame, m: DataFrame) -> DataFrame:
    wins = (m.filter(F.col("winner_team_id").isNotNull())
            .groupBy("winner_team_id").agg(F.count(F.lit(1)).alias("wins")))
    w = Window.partitionBy("tournament_id").orderBy(
        F.coalesce(F.col("wins"), F.lit(0)).desc(), F.col("team_id"))
    z = (tm.filter(F.col("i") != 15)
         .join(wins, F.col("winner_team_id") == F.col("team_id"), "left")
         .select("tournament_id", "team_id",
                 F.row_number().over(w).cast("int").alias("finishing_pos")))
    pos = F.col("finishing_pos")
    return z.select(
        "tournament_id", "team_id", "finishing_pos",
        F.when(pos % 7 == 0, F.lit(None)).otherwise(1600 - 100 * pos).cast("int").alias("points"),
        F.when(pos % 5 == 0, F.lit(None)).otherwise(20000 - 1000 * pos)
         .cast("double").alias("prize_money"))


def rankings(t: DataFrame) -> DataFrame:
    p = (t.select("y", F.floor((F.col("m") + 2) / 3).cast("bigint").alias("q"), "g")
         .distinct())
    kinds = F.array(*[F.struct(F.lit(n).alias("rt"), F.lit(off).alias("off"))
                      for n, off in RANKING_TYPES])
    s = (p.select("y", "q", "g", _slots(RANKED_SLOTS).alias("i"))
         .select("*", F.explode(kinds).alias("kind"))
         .select("*", "kind.rt", "kind.off"))
    y, q, g, i = F.col("y"), F.col("q"), F.col("g"), F.col("i")
    slot = (i * 7 + q * 3 + y + F.col("off")) % 16
    pa = (4 * i + g + 1).cast("bigint")
    pb = _partner(i, y, g).cast("bigint")
    even = i % 2 == 0
    return s.select(
        F.col("rt").alias("ranking_type"),
        F.make_date(y.cast("int"), (q * 3 - 2).cast("int"), F.lit(15)).alias("snapshot_date"),
        F.when(g == 0, "M").otherwise("W").alias("gender"),
        (slot + 1).cast("int").alias("position"),
        F.when(even, pa).otherwise(pb).alias("no_player1"),
        F.when(even, pb).otherwise(pa).alias("no_player2"),
        ((16 - slot) * 50).cast("int").alias("earned_points"))


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw-layer tables (typed, full column list) derived from the test tables.

    Columns the fixture does not define are typed NULLs or simple expressions,
    identical on the oracle side.
    """
    b = base(spark, sf_dir)
    t = tournaments(b)
    tm = teams(t)
    m = matches(b)
    out = {
        "players": players(spark, sf_dir).select(
            "player_id", _null("string").alias("first_name"), _null("string").alias("last_name"),
            "full_name", "gender", _null("date").alias("birth_date"), "height_cm",
            "country_code", _null("string").alias("profile_url")),
        "tournaments": t.select(
            "tournament_id", "name", "season", "tier", "start_date", "end_date",
            _null("string").alias("city"), "country_code", "country_name", "gender",
            _null("string").alias("status"), F.lit("UTC").alias("timezone")),
        "teams": tm.select(
            "team_id", "tournament_id", "player_a_id", "player_b_id", "country_code",
            _null("string").alias("status"), _null("date").alias("valid_from"),
            _null("date").alias("valid_to")),
        "matches": m.select(
            "match_id", "tournament_id", "phase", "round", "team1_id", "team2_id",
            "winner_team_id",
            F.when(F.col("winner_team_id") == F.col("team1_id"), "2-0")
             .when(F.col("winner_team_id") == F.col("team2_id"), "0-2").alias("score_sets"),
            (30 + F.col("match_id") % 31).cast("int").alias("duration_minutes"),
            "played_at", _null("string").alias("result_type"),
            _null("string").alias("status")),
        "results": results(tm, m),
        "rounds": rounds(t).select(
            "round_id", "tournament_id", "code", "name", "bracket", "phase", "start_date",
            _null("date").alias("end_date"), _null("string").alias("rank_method")),
        "team_rankings": rankings(t).select(
            "ranking_type", "snapshot_date", "gender", "position", "no_player1", "no_player2",
            _null("string").alias("team_name"), "earned_points"),
        "events": events(spark, sf_dir),
    }
    return out


def input_version(spark: SparkSession, sf_dir: str) -> tuple:
    """The files of the tables that the raw layer is derived from: path, size, time of change."""
    out = []
    for t in INPUT_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return tuple(sorted(out))


class TableStore:
    """Tables written once under the shared checkpoint folder and read back.

    In the modelled system the raw layer and the reused models are stored
    tables; writing them cuts lineage and gives the planner real file sizes.
    The caller owns a store and says by the key what a table was made from, so
    changed input is a new key.  A table counts only after its write succeeded.

    A table of a few MB ends up in one or two files, and every reader would run
    on as many cores (parsing is work for the CPU, not for the disk).  Such a
    table is dealt out to a file a core; larger ones are left as written.
    """

    #: Dealt out to a file a core: tables from SPREAD_FROM bytes to SPREAD_TO bytes a core.
    SPREAD_FROM, SPREAD_TO = 256 << 10, 4 << 20

    def __init__(self) -> None:
        self._tables: dict[tuple, DataFrame] = {}

    def __call__(self, spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        k = (spark.sparkContext.applicationId, *key)
        if k not in self._tables:
            path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/courtline-{key[-1]}-{uuid.uuid4().hex}"
            build().write.mode("overwrite").parquet(path)
            self._tables[k] = self._spread(spark, path)
        return self._tables[k]

    def _spread(self, spark: SparkSession, path: str) -> DataFrame:
        written = spark.read.parquet(path)
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        sizes = [f.getLen() for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root) if f.getPath().getName().endswith(".parquet")]
        cores = spark.sparkContext.defaultParallelism
        if len(sizes) >= cores or not self.SPREAD_FROM <= sum(sizes) < self.SPREAD_TO * cores:
            return written
        written.repartition(cores).write.parquet(f"{path}-spread")
        return spark.read.parquet(f"{path}-spread")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events from the driver's ``events`` table (one per event_id)."""
    e = read_table(spark, sf_dir, "events")
    d = F.to_date("ts")
    return e.select(
        F.col("event_id"),
        F.upper(F.col("event_type")).alias("code"),
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("name"),
        d.alias("start_date"),
        F.date_add(d, (F.col("user_id") % 5).cast("int")).alias("end_date"),
        F.col("event_type").alias("type"),
        _null("bigint").alias("no_parent_event"),
        F.concat(F.lit("N"), (F.col("user_id") % 6).cast("string")).alias("country_code"),
        (F.col("value") > 10).alias("has_beach_tournament"),
        (F.col("user_id") % 2 == 0).alias("has_men_tournament"),
        (F.col("user_id") % 2 == 1).alias("has_women_tournament"),
        (F.col("event_type") == "view").alias("is_vis_managed"))
