"""License scans by ordered signatures, with Spark expressions only (operator 4).

A text becomes its words (A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``)
with one blank before, between and after.  Base phrases are counted on that.
Signatures (``license_rules``) are tried only if the text holds their gate and
their keyword, which are words of every match.  Detections are intervals; one is
suppressed if another of the same or a higher priority contains it (of equal
intervals the earlier signature stays).  A running maximum over a text's
detections, sorted by place, finds that out, so no pairs are made.

Only detections are shuffled, never texts.

Defined cases: a null or empty text has no words, null places, empty labels
and score 0; repeated rows and rows without an id each give a row; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.license_rules import WEIGHTS, gates, rules
from courtline.llm.store import stored

#: phrase and label of the base scan (fixed values)
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
BASE_SCORE = 0.5
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _blanks(x: Column) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).cast("bigint")


def with_words(df: DataFrame, text: Column) -> DataFrame:
    """Adds words (" w w w ", or two blanks) and n_words."""
    df = df.withColumn("words", F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SEPARATORS, " ")))
    return df.withColumn("n_words", F.when(F.col("words") == "", F.lit(0).cast("bigint")).otherwise(_blanks(F.col("words")) + 1)).withColumn("words", F.concat(F.lit(" "), "words", F.lit(" ")))


def _rule_array() -> Column:
    """All signatures as one constant, which is folded once (thousands of literals would take the driver half a minute to plan)."""
    return F.from_json(F.lit(json.dumps([asdict(r) for r in rules()])), "array<struct<number int, label string, keyword string, pattern string, priority int, gate string>>")


def scan(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found (detections that stay) of every row."""
    docs = with_words(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), F.col("text")).drop("text")

    # base phrases: the text split at each phrase gives their number and how many words stand before and after
    for k, (phrase, _) in enumerate(PHRASES):
        docs = docs.withColumn(f"split{k}", F.when(F.contains("words", F.lit(f" {phrase} ")), F.split("words", f" {phrase}(?= )", -1)))
    firsts, lasts, counts, labels = [], [], [], []
    for k, (phrase, label) in enumerate(PHRASES):
        at = F.col(f"split{k}")
        firsts.append(_blanks(at[0]))
        lasts.append(F.col("n_words") - (_blanks(F.element_at(at, -1)) - 1) - len(phrase.split()))
        counts.append(F.when(at.isNotNull(), F.size(at) - 1).otherwise(0))
        labels.append(F.when(at.isNotNull(), F.lit(label)))
    docs = docs.select("doc_id", "words", "n_words", sum(counts[1:], counts[0]).cast("bigint").alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"), F.array_sort(F.array_compact(F.array(*labels))).alias("base"))

    # signatures: for each that is tried, the lengths of what stands before each match and of the match
    every = rules()
    keywords = F.array(*(F.lit(k) for k in dict.fromkeys(r.keyword for r in every)))
    # a signature's gate and keyword are both in any text that it matches
    docs = docs.withColumn("gates", F.filter(F.array(*(F.lit(g) for g in gates())), lambda g: F.contains("words", g)))
    docs = docs.withColumn("held", F.when(F.size("gates") > 0, F.filter(keywords, lambda k: F.contains("words", k))))
    tried = F.filter(_rule_array(), lambda r: F.array_contains("held", r["keyword"]) & F.array_contains("gates", r["gate"]))

    def lengths(r: Column) -> Column:
        got = F.regexp_extract_all("words", r["pattern"], F.lit(0))
        before = F.transform(F.split("words", r["pattern"], -1), lambda p: F.length(p))
        return F.struct(r["number"].alias("number"), r["label"].alias("label"), r["priority"].alias("priority"), F.zip_with(F.transform(got, lambda m: F.length(m)), F.slice(before, 1, F.greatest(F.size(got), F.lit(1))), lambda m, b: F.struct(b.alias("before"), m.alias("size"))).alias("at"))

    found = F.when(F.size("held") > 0, F.filter(F.transform(tried, lengths), lambda f: F.get(f["at"], F.lit(0))["size"].isNotNull()))
    # a stored row number names a row, however often its id occurs
    table = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "n_base", "first_word", "last_word", "base", found.alias("found")), "license-rows")

    each = table.filter(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.number", "f.label", "f.priority", F.posexplode("f.at").alias("k", "m"))
    so_far = F.sum(F.col("m.before") + F.col("m.size")).over(Window.partitionBy("row", "number").orderBy("k"))
    placed = each.select("row", "number", "label", "priority", (so_far - F.col("m.size")).alias("start"), so_far.alias("end"))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "number").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in WEIGHTS:
        reach = F.max(F.when(F.col("priority") >= p, F.col("end"))).over(earlier)
        inside = F.when(F.col("priority") == p, F.coalesce(reach >= F.col("end"), F.lit(False))).otherwise(inside)
    stays = placed.withColumn("inside", inside).filter(~F.col("inside"))
    weight = F.lit(0.0)
    for p, w in WEIGHTS.items():
        weight = F.when(F.col("priority") == p, F.lit(w)).otherwise(weight)
    by_row = stays.groupBy("row").agg(F.collect_set("label").alias("own"), F.max(weight).alias("best"), F.count("*").alias("n_found"))

    out = table.drop("found").join(by_row, "row", "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(BASE_SCORE)).otherwise(0.0))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_distinct("base"), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(F.col("base"), own)), ",").alias("labels"), score.alias("score"), F.coalesce("n_found", F.lit(0)).alias("n_found"))
