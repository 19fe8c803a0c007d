"""The corpus pipeline: language id, quality rules, near-dedup, repeated-passage removal, packing.

Each stage takes what the one before kept, written as Parquet and read again.
All stages but the last return the columns of documents; the last returns the
pieces of the packed sequences.  Rows with a null or empty text, or without a
letter, go in the first stage; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import bwt_dedup, chosen_path, language_id, packing, repetition
from courtline.llm.store import stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised (operator 5)."""
    return language_id.keep_accepted(docs, language_id.fit(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that don't repeat themselves (operator 6)."""
    return repetition.keep_unrepeated(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near duplicates: five-word shingles, similarity 0.8 or more (operator 9)."""
    return chosen_path.one_of_each(docs, shingle=5, similarity=(80, 100))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out byte strings of 100 and more that also stand earlier (operator 7)."""
    return bwt_dedup.without_repeats(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left, every source at its share (operator 3)."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("packing", packing_stage),
]

#: SQL can't express these stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
