"""What is known of each tournament's loads, kept up from batches alone.

The skip rule needs the newest ingest time of a tournament's results and rounds
and whether a check found none.  Both merge: newest of times, any of "has
rows", last of checks.  So one row a tournament is carried from batch to batch
and no batch has to read the loaded tables again.

Ingest times only grow (an upsert stamps what it writes), so the newest of a
tournament never goes back; loaded rows are replaced, never removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "tournament_id"
STATE = "tournament_id bigint, last_ingested timestamp, has_results boolean, has_rounds boolean, results_empty_at timestamp, rounds_empty_at timestamp"


def batch_state(results: DataFrame, rounds: DataFrame, checked: DataFrame, now: Column) -> DataFrame:
    """What one batch says of its tournaments: its rows and, for those checked, the time of the check."""
    loaded = (results.select(KEY, "ingested_at", F.lit(True).alias("r"), F.lit(False).alias("o"), F.lit(None).cast("timestamp").alias("c"))
              .unionByName(rounds.select(KEY, "ingested_at", F.lit(False).alias("r"), F.lit(True).alias("o"), F.lit(None).cast("timestamp").alias("c")))
              .unionByName(checked.select(KEY, F.lit(None).cast("timestamp").alias("ingested_at"), F.lit(False).alias("r"), F.lit(False).alias("o"), now.cast("timestamp").alias("c"))))
    return (loaded.filter(F.col(KEY).isNotNull()).groupBy(KEY)
            .agg(F.max("ingested_at").alias("last_ingested"), F.bool_or("r").alias("has_results"), F.bool_or("o").alias("has_rounds"), F.max("c").alias("checked_at")))


def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after a batch.  Only tournaments of the batch change; a check sees the rows up to and with its batch."""
    s, b = state.alias("s"), batch.alias("b")

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"s.{name}"), F.lit(False)) | F.coalesce(F.col(f"b.{name}"), F.lit(False))

    def mark(name: str, has: str) -> Column:
        return F.when(F.col("b.checked_at").isNotNull(), F.when(~either(has), F.col("b.checked_at"))).otherwise(F.col(f"s.{name}")).alias(name)

    return s.join(b, F.col(f"s.{KEY}") == F.col(f"b.{KEY}"), "full").select(
        F.coalesce(f"s.{KEY}", f"b.{KEY}").alias(KEY), F.greatest("s.last_ingested", "b.last_ingested").alias("last_ingested"),
        either("has_results").alias("has_results"), either("has_rounds").alias("has_rounds"),
        mark("results_empty_at", "has_results"), mark("rounds_empty_at", "has_rounds"))
