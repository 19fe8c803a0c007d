"""Unordered-pair keys, latest-row-per-key and as-of joins.

Spark finds equi-join keys only in conjunctions, so a condition such as
``(x1 = a and x2 = b) or (x1 = b and x2 = a)`` leaves a join keyed on almost
nothing.  We rewrite it to an equi-join on a canonical pair key
``(least, greatest)``.  The as-of step ("newest snapshot at or before the event
date") is resolved once per distinct (key, event date) rather than once per
event row, so its cost grows with the number of distinct dates per pair, not
with how many events share a date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OrderSpec = Sequence[Column | str]
#: Width of a span of the as-of join by spans.
BUCKET_DAYS = 365


def pair_key(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """Canonical (lo, hi) of an unordered pair; both NULL unless both ids are set.

    ``least``/``greatest`` skip NULLs, so an unguarded key would match a pair
    with a missing player; SQL equality would not.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.least(a, b)), F.when(both, F.greatest(a, b))


def _order(cols: OrderSpec) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """Keep the first row per key under ``order`` (``row_number() = 1``).

    Spark plans ``row_number`` filtered to 1 with a partial group limit before
    the shuffle, so each map task ships at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def newest_by_date(df: DataFrame, keys: Sequence[str], date: str, order: str,
                   values: Sequence[str]) -> DataFrame:
    """Per key the row with the latest ``date``, of those the one with the highest ``order``: keys, date, order, values.

    For fixed-width values and (date, order) unique within a key.  Hash
    aggregations, first per day: no task sorts the rows, and a key with very
    many of them leaves each task as one row a day.
    """
    days = df.groupBy(*keys, date).agg(F.max(order).alias("__o"), *[
        F.max_by(v, order).alias(f"__v{i}") for i, v in enumerate(values)])
    return days.groupBy(*keys).agg(F.max(date).alias("__d"), F.max_by("__o", date).alias("__o"), *[
        F.max_by(f"__v{i}", date).alias(f"__v{i}") for i in range(len(values))]).select(
        *keys, F.col("__d").alias(date), F.col("__o").alias(order),
        *[F.col(f"__v{i}").alias(v) for i, v in enumerate(values)])


def asof_latest(events: DataFrame, snaps: DataFrame, on: Sequence[str], event_date: str,
                snap_date: str, values: Sequence[str], tie_break: Sequence[str] = (),
                method: str = "fill", bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Newest snapshot with ``snap_date <= event_date`` per distinct (on, event_date).

    Returns ``on + [event_date, snap_date] + values`` for every distinct event
    key that has such a snapshot.  ``tie_break`` orders snapshots that share a
    date (first wins).  Rows with a NULL key never match, as in SQL.

    * ``method="range"``: equi-join on ``on`` with the range condition, then
      keep the newest.  Output before the reduction is
      (distinct event dates) x (snapshots of the key).
    * ``method="fill"``: union the event keys and the snapshots (one per key
      and date), sort by date within the key with snapshots first, and carry
      the last snapshot forward.  Linear in rows per key; no product.
    * ``method="buckets"``: the same carry within spans of ``bucket_days``, so
      that a key's timeline is many tasks.  What a span begins with is the newest
      snapshot of the spans before it: one row a span and key, itself carried
      forward.  For keys with very long timelines; any width gives the same rows.
    """
    on = list(on)
    values = list(values)
    not_null = [F.col(c).isNotNull() for c in on]
    ev = events.select(*on, event_date)
    for c in not_null + [F.col(event_date).isNotNull()]:
        ev = ev.filter(c)
    ev = ev.distinct()
    sn = snaps.select(*on, snap_date, *values, *[c for c in _tie_cols(tie_break)
                                                  if c not in values])
    for c in not_null + [F.col(snap_date).isNotNull()]:
        sn = sn.filter(c)

    if method == "range":
        cond = [ev[c] == sn[c] for c in on] + [sn[snap_date] <= ev[event_date]]
        j = ev.join(sn, cond).select(*[ev[c] for c in on], ev[event_date], sn[snap_date],
                                     *[sn[v] for v in values], *[sn[c] for c in _tie_cols(tie_break)
                                                                 if c not in values])
        best = latest_per_key(j, on + [event_date], [F.col(snap_date).desc(), *_tie_order(tie_break)])
        return best.select(*on, event_date, snap_date, *values)

    if method not in ("fill", "buckets"):
        raise ValueError(f"unknown as-of method {method!r}")
    # one snapshot per (key, date): the tie-break winner
    sn1 = latest_per_key(sn, on + [snap_date], _tie_order(tie_break)) if tie_break else sn
    snap_struct = F.struct(F.col(snap_date).alias("__sd"), *[F.col(v) for v in values])
    u = (sn1.select(*on, F.col(snap_date).alias("__d"), F.lit(0).alias("__kind"),
                    snap_struct.alias("__v"))
         .unionByName(ev.select(*on, F.col(event_date).alias("__d"), F.lit(1).alias("__kind"),
                                F.lit(None).cast(snap_struct_type(sn1, snap_date, values))
                                .alias("__v"))))
    span = list(on)
    if method == "buckets":
        u = u.withColumn("__b", F.floor(F.datediff("__d", F.lit("1970-01-01").cast("date")) / bucket_days))
        span = [*on, "__b"]
    w = (Window.partitionBy(*span).orderBy("__d", "__kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = u.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).filter(F.col("__kind") == 1)
    if method == "buckets":
        before = Window.partitionBy(*on).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        tails = u.groupBy(*span).agg(F.max_by("__v", F.when(F.col("__kind") == 0, F.col("__d"))).alias("__tail"))
        carried = tails.select(*span, F.last("__tail", ignorenulls=True).over(before).alias("__carry"))
        filled = filled.join(carried.filter(F.col("__carry").isNotNull()), span, "left").withColumn("__v", F.coalesce("__v", "__carry"))
    filled = filled.filter(F.col("__v").isNotNull())
    return filled.select(*on, F.col("__d").alias(event_date),
                         F.col("__v.__sd").alias(snap_date),
                         *[F.col(f"__v.{v}").alias(v) for v in values])


def _tie_cols(tie_break: Sequence[str]) -> list[str]:
    """Column names of a tie-break spec such as ``["ranking_type", "position desc"]``."""
    return [t.split()[0] for t in tie_break]


def _tie_order(tie_break: Sequence[str]) -> list[Column]:
    out = []
    for t in tie_break:
        name, *rest = t.split()
        out.append(F.col(name).desc() if rest and rest[0].lower() == "desc" else F.col(name).asc())
    return out


def snap_struct_type(df: DataFrame, snap_date: str, values: Sequence[str]) -> str:
    fields = [f"__sd {df.schema[snap_date].dataType.simpleString()}"]
    fields += [f"{v} {df.schema[v].dataType.simpleString()}" for v in values]
    return "struct<" + ", ".join(fields) + ">"
