"""Keyed upsert and the incremental-ingest decisions.

``upsert`` produces the new state of a keyed table as a DataFrame: the target
less the batch's keys, and the newest row of each key of the batch.  Writing it is the
caller's choice (``courtline.sources.sinks``); on a table format with MERGE
the same keys and order give the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.operators.pairs import latest_per_key

# Fixed defaults of the loader's skip rule (days, hours, days) and first year expanded.
RECENT_CUTOFF_DAYS = 90.0
RECENT_WINDOW_HOURS = 24.0
OLDER_WINDOW_DAYS = 30.0
MIN_EXPAND_YEAR = 2015
# Result phases in increasing priority (the last one wins on a shared key).
RESULT_PHASES = ("none", "MainDraw", "Qualification")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last under ``order``."""
    return latest_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str,
           ingested_at: Column) -> DataFrame:
    """Insert or overwrite by key (S5): batch rows replace target rows.

    Within the batch the row with the greatest ``seq`` wins; ``ingested_at``
    of replaced or inserted rows is set to the given time; target rows whose
    key is not in the batch are kept unchanged.  Columns are the target's.

    Only the batch is aggregated.  The target loses the batch's keys by an
    anti-join, for which Spark broadcasts the keys when they measure small, so
    a small batch moves no row of the target.  A target holds a key once; keys
    with a NULL are matched like any other value.
    """
    cols = [c for c in target.columns]
    b = batch.withColumn("ingested_at", ingested_at.cast("timestamp")) \
        if "ingested_at" in cols else batch
    newest = last_wins(b.select(*cols), keys, [seq])
    gone = newest.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return target.select(*cols).join(gone, same, "left_anti").unionByName(newest)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain append."""
    return target.unionByName(batch)


def latest_ingest(tables: Sequence[DataFrame], key: str, ts: str = "ingested_at") -> DataFrame:
    """Newest ``ts`` per key over a union of tables."""
    u = None
    for t in tables:
        s = t.select(key, ts)
        u = s if u is None else u.unionByName(s)
    return u.groupBy(key).agg(F.max(ts).alias("last_ingested"))


def phase_merge(phases: Mapping[str, DataFrame], keys: Sequence[str],
                priority: Sequence[str] = RESULT_PHASES) -> DataFrame:
    """Combine per-phase results; on a shared key the higher-priority phase wins."""
    u = None
    for name, df in phases.items():
        s = df.withColumn("phase", F.lit(name)).withColumn("_prio", F.lit(priority.index(name)))
        u = s if u is None else u.unionByName(s)
    return last_wins(u, keys, ["_prio"]).drop("_prio")


def snapshot_stamp(lists: DataFrame, snapshot_date: Column) -> DataFrame:
    """Stamp the rows of fetched ranking lists (each with its type and gender) with the snapshot
    date, all lists in one pass."""
    return lists.select("ranking_type", snapshot_date.cast("date").alias("snapshot_date"), "gender",
                        *[c for c in lists.columns if c not in ("ranking_type", "snapshot_date", "gender")])


def tournament_year(season: Column, start: Column, end: Column) -> Column:
    """Year from a plain-integer season in 1900-2100, else the start year, else the end year."""
    s = F.regexp_replace(season, r"^\s+|\s+$", "")
    y = F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))
    ok = y.between(1900, 2100)
    return F.coalesce(F.when(ok, y), F.year(start), F.year(end))


def expand_set(tournaments: DataFrame, as_of_date: Column, min_year: int = MIN_EXPAND_YEAR) -> DataFrame:
    """Tournaments to expand: year unknown or >= min_year, and not starting after today."""
    y = tournament_year(F.col("season"), F.col("start_date"), F.col("end_date"))
    keep = (y.isNull() | (y >= min_year)) & (F.col("start_date").isNull()
                                             | (F.col("start_date") <= as_of_date))
    return tournaments.filter(keep).select("tournament_id", y.alias("year"))


def skip_set(tournaments: DataFrame, results: DataFrame, rounds: DataFrame,
             empty_checks: DataFrame, now: Column, recent_cutoff_days: float = RECENT_CUTOFF_DAYS,
             recent_window_hours: float = RECENT_WINDOW_HOURS,
             older_window_days: float = OLDER_WINDOW_DAYS) -> DataFrame:
    """Tournaments ingested recently enough to skip, plus recently confirmed-empty ones.

    Recent tournaments (start within the cutoff) skip if ingested within the
    recent window; older or undated ones if within the older window.  A
    window of 0 disables that part.  ``now`` is a parameter, not the clock.
    """
    last = latest_ingest([results, rounds], "tournament_id")
    return skip_by_last(tournaments, last, empty_checks, now, recent_cutoff_days, recent_window_hours, older_window_days)


def skip_by_last(tournaments: DataFrame, last: DataFrame, empty_checks: DataFrame, now: Column,
                 recent_cutoff_days: float = RECENT_CUTOFF_DAYS, recent_window_hours: float = RECENT_WINDOW_HOURS,
                 older_window_days: float = OLDER_WINDOW_DAYS) -> DataFrame:
    """S13 from each tournament's newest ingest (``last_ingested``) and marks, as ``operators.freshness`` keeps them."""
    now_ts = now.cast("timestamp")
    today = F.to_date(now_ts)

    def ago(seconds: float) -> Column:
        return now_ts - F.make_dt_interval(secs=F.lit(seconds))

    parts = []
    if recent_window_hours > 0 or older_window_days > 0:
        cutoff = F.date_sub(today, int(recent_cutoff_days)) if float(recent_cutoff_days).is_integer() \
            else F.to_date(ago(recent_cutoff_days * 86400))
        start = F.col("start_date")
        li = F.col("last_ingested")
        recent = (start >= cutoff) & (li >= ago(recent_window_hours * 3600))
        older = (start.isNull() | (start < cutoff)) & (li >= ago(older_window_days * 86400))
        parts.append(last.join(tournaments.select("tournament_id", "start_date"), "tournament_id")
                     .filter(recent | older).select("tournament_id"))
    if older_window_days > 0:
        lim = ago(older_window_days * 86400)
        parts.append(empty_checks.filter(
            F.col("results_empty_at").isNotNull() & F.col("rounds_empty_at").isNotNull()
            & (F.col("results_empty_at") >= lim) & (F.col("rounds_empty_at") >= lim))
            .select("tournament_id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def to_load(candidates: DataFrame, skip: DataFrame, key: str = "tournament_id") -> DataFrame:
    """Candidates minus the skip set."""
    return candidates.join(skip, key, "left_anti")


def empty_checks(checked: DataFrame, results: DataFrame, rounds: DataFrame, now: Column,
                 previous: DataFrame | None = None) -> DataFrame:
    """Per checked tournament, stamp (or clear) 'results empty' and 'rounds empty'.

    A tournament checked now with no result rows gets ``results_empty_at =
    now``; with rows, the mark is cleared; the same for rounds.  Marks of
    tournaments not checked now are kept from ``previous``.
    """
    has_r = results.select("tournament_id").distinct().withColumn("_r", F.lit(True))
    has_o = rounds.select("tournament_id").distinct().withColumn("_o", F.lit(True))
    ts = now.cast("timestamp")
    cur = (checked.select("tournament_id").distinct()
           .join(has_r, "tournament_id", "left").join(has_o, "tournament_id", "left")
           .select("tournament_id",
                   F.when(F.col("_r").isNull(), ts).alias("results_empty_at"),
                   F.when(F.col("_o").isNull(), ts).alias("rounds_empty_at")))
    if previous is None:
        return cur
    return previous.join(cur.select("tournament_id"), "tournament_id", "left_anti").unionByName(cur)


def source_filter_tournaments(tournaments: DataFrame, seasons: Sequence[str]) -> DataFrame:
    """Tournament list restricted to seasons."""
    return tournaments.filter(F.col("season").isin(list(seasons)))


def source_filter_events(events: DataFrame, start: str, end: str, beach_only: bool = True,
                         top_level_only: bool = True) -> DataFrame:
    """Events in a date range, beach flag, top-level only (no parent)."""
    c = (F.col("start_date") >= F.lit(start).cast("date")) & (F.col("end_date") <= F.lit(end).cast("date"))
    if beach_only:
        c = c & F.col("has_beach_tournament")
    if top_level_only:
        c = c & (F.coalesce(F.col("no_parent_event"), F.lit(0)) == 0)
    return events.filter(c)
