"""courtline: league and tournament analytics on Spark.

Entry points: ``courtline.league.League`` (all models over a raw layer),
``courtline.sources.ingest`` (response bodies -> typed raw rows),
``courtline.operators`` (pair/as-of joins, Elo, upsert, quality, previews),
``courtline.streaming`` (incremental ingest).  Every function takes and
returns DataFrames.
"""

__version__ = "0.1.0"
