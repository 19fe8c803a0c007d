"""Chat formatting with Spark expressions only (operator 2).

A conversation's turns are collected as structs and sorted, adjacent turns of
one role become one block, and blocks are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

``<|im_sep|>`` stands between the texts of merged turns, so every turn can be
read back.  Inside texts and roles a backslash is doubled and ``<|`` becomes
``<\\|``, so no text can hold a mark; in roles a line end becomes ``<\\^``.

``segments`` cuts the formatted string into (text, loss) pairs: loss is true
on the texts of ``loss_role`` and nowhere else.

Turns are collected in two steps (ranges of ``CHUNK`` turn numbers, then the
conversation), so a long conversation is sorted in parts; its one output
string is all that a task must hold.

Defined cases: null text or role is empty; a null turn comes first; turns that
tie are ordered by role, then text; repeated rows are turns of their own; rows
without a conversation id form one conversation; an empty table gives none;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
CHUNK = 256


def _quoted(mark: str) -> str:
    """A mark as a regular expression."""
    return mark.replace("|", "\\|")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\^"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\^"), F.lit("\n")))


def _sorted_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id and its turns, in order."""
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "turns"))).alias("parts"))
    return whole.select("conv_id", F.flatten(F.col("parts.turns")).alias("turns"))


def format_chats(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>>, n_turns, n_blocks."""
    turns = _sorted_turns(df, conv_col, turn_col, role_col, text_col)
    at = F.sequence(F.lit(0), F.size("turns") - 1)
    # where a block begins: the role is another than the turn's before
    begins = F.filter(at, lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]))
    marked = turns.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", 2, F.greatest(F.size("begins"), F.lit(1))), F.array(F.size("turns")))
    marked = marked.withColumn("ends", ends)
    blocks = F.zip_with("begins", "ends", lambda b, e: F.struct(F.col("turns")[b]["role"].alias("role"), F.transform(F.slice("turns", b + 1, e - b), lambda t: escape(t["text"])).alias("texts")))
    merged = marked.withColumn("blocks", blocks)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(b: Column) -> Column:
        no = F.lit(False)
        texts = F.transform(b["texts"], lambda t, i: F.when(i == 0, F.array(segment(t, b["role"] == loss_role))).otherwise(F.array(segment(F.lit(SEPARATOR), no), segment(t, b["role"] == loss_role))))
        head = F.array(segment(F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n")), no))
        return F.concat(head, F.flatten(texts), F.array(segment(F.lit(END), no)))

    cut = merged.withColumn("segments", F.flatten(F.transform("blocks", of_block)))
    return cut.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments", F.size("turns").cast("bigint").alias("n_turns"), F.size("blocks").cast("bigint").alias("n_blocks"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, one for each that went in."""
    pieces = F.split(formatted, _quoted(END), -1)
    blocks = F.slice(pieces, 1, F.size(pieces) - 1)               # nothing stands after the last end

    def of_block(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        body = F.substr(b, F.length(role) + 2)
        plain = unescape_role(F.substr(role, F.lit(len(START) + 1)))
        return F.transform(F.split(body, _quoted(SEPARATOR), -1), lambda t: F.struct(plain.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
