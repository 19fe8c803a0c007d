"""Quality rules from suffix arrays (operator 6).

Texts of an Arrow batch are sorted together: every word becomes a symbol of
its own text, and prefix doubling (only among suffixes still tied) gives the
suffix array of all of them at once, with the ranks of each doubling step.
From those ranks, the longest common prefix of neighbours follows by binary
lifting.  Neighbours with a common prefix of ``min_words`` or more bound the
intervals of maximal repeated substrings; the union of all their occurrences
is what repeats.  A text is kept if that union covers at most ``max_covered``
of its word bytes and the longest repeat is at most ``longest_words`` words,
however long the text is.  (A limit in shares could not act by itself: two
places of a repeat over 15% of the words already cover more than the base
rule's 30%.)

Base counts (words are ``[^\\x20\\x09-\\x0D]+``): see ``repetition_rules``.

Defined cases: a null or empty text has zero counts and fails (fewer than 20
words); repeated rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.store import tune

RANGE_BYTES = 2 << 20
WINDOW = 8
COLUMNS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, covered_share double, longest_repeat bigint, base_failed boolean, kept boolean"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LINE_END = np.zeros(256, dtype=bool)
_LINE_END[0x0A] = True


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of several sequences, and the ranks by prefixes of 1, 2, 4, ... symbols.

    ``symbols``: no symbol is in two sequences.  ``ends``: for every position,
    where its sequence ends.  A rank is the place in the suffix array where the
    group of equal prefixes begins; a prefix cut short by its sequence's end
    equals no other.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = symbols[order][1:] != symbols[order][:-1]
    heads = np.flatnonzero(new)
    group = np.repeat(heads, np.diff(np.append(heads, n)))
    rank[order] = group
    levels, step = [rank], 1
    at = np.flatnonzero(~new | np.append(~new[1:], False))       # places in the array that are still tied
    while len(at):
        pos = order[at]
        nxt = pos + step
        inside = nxt < ends[pos]
        second = np.where(inside, rank[np.minimum(nxt, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[pos]))
        pos, first, second = pos[by], rank[pos][by], second[by]
        new = np.ones(len(at), bool)
        # a suffix cut short stands alone
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (second[1:] == 0)
        heads = np.flatnonzero(new)
        order[at] = pos
        rank = rank.copy()
        rank[pos] = np.repeat(at[heads], np.diff(np.append(heads, len(at))))
        levels.append(rank)
        at = at[~new | np.append(~new[1:], False)]
        step *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray, least: int) -> np.ndarray:
    """lcp[k] of the suffixes at places k - 1 and k of the array, in symbols; 0 where it is under ``least`` (a power of two)."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    level = least.bit_length() - 1
    if level >= len(levels) or n < 2:
        return lcp
    tied = np.flatnonzero(levels[level][order[1:]] == levels[level][order[:-1]]) + 1
    a, b = order[tied - 1], order[tied]
    size = np.zeros(len(tied), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + size, b + size
        same = (x < ends[a]) & (y < ends[b])
        same[same] = levels[k][x[same]] == levels[k][y[same]]
        # equal ranks at a level mean equal prefixes only while neither is cut short, which are never tied
        size += same * (1 << k)
    lcp[tied] = size
    return lcp


def judge(data: np.ndarray, offsets: np.ndarray, *, max_covered: float, longest_words: int) -> dict[str, np.ndarray]:
    """All columns for the texts of one range."""
    docs = len(offsets) - 1
    space = T.IS_SPACE[data]
    starts, stops = T.spans(~space, offsets)
    per = T.per_text(starts, offsets)
    n_words = np.diff(per)
    code_points = (data & 0xC0) != 0x80
    out = {"n_words": n_words, "word_chars": _per_doc(code_points & ~space, offsets), "n_symbols": _per_doc(_SYMBOL[data], offsets)}

    # lines with a word, equal to an earlier one: all such lines less the distinct ones
    begin, end = T.spans(~_LINE_END[data], offsets)
    filled = np.concatenate([[0], np.cumsum(~space)])
    has = filled[end] > filled[begin]
    begin, end = begin[has], end[has]
    line_doc = np.searchsorted(offsets, begin, "right") - 1
    line = T.hash_spans(data, begin, end)
    by = np.lexsort((line, line_doc))
    again = (line[by][1:] == line[by][:-1]) & (line_doc[by][1:] == line_doc[by][:-1])
    out["n_dup_lines"] = np.bincount(line_doc[by][1:][again], minlength=docs)

    doc = np.repeat(np.arange(docs), n_words)
    covered = np.zeros(len(starts), bool)
    longest = np.zeros(docs, np.int64)
    if len(starts):
        ends = np.repeat(per[1:], n_words)
        words = T.hash_spans(data, starts, stops)
        by = np.argsort(words, kind="stable")
        new = np.ones(len(words), np.int64)
        new[1:] = words[by][1:] != words[by][:-1]
        ids = np.empty(len(words), np.int64)
        ids[by] = np.cumsum(new)
        order, levels = suffix_ranks(doc * (int(ids.max()) + 1) + ids, ends)
        lcp = common_prefixes(order, levels, ends, WINDOW)
        repeat = np.zeros(len(starts), np.int64)
        repeat[order] = np.maximum(lcp[:-1], lcp[1:])            # the longest repeat that starts at a word
        hit = np.flatnonzero(repeat)
        delta = np.zeros(len(starts) + 1, np.int64)
        np.add.at(delta, hit, 1)
        np.add.at(delta, hit + repeat[hit], -1)
        covered = np.cumsum(delta[:-1]) > 0
        np.maximum.at(longest, doc[hit], repeat[hit])
    size = stops - starts
    word_bytes = np.bincount(doc, weights=size, minlength=docs)
    covered_bytes = np.bincount(doc, weights=size * covered, minlength=docs)
    repeated = np.bincount(doc, weights=covered, minlength=docs).astype(np.int64)
    share = np.divide(covered_bytes, word_bytes, out=np.zeros(docs), where=word_bytes > 0)
    failed = (n_words < 20) | (100 * repeated > 30 * n_words)
    too_long = longest > longest_words
    return out | {"n_repeat_words": repeated, "covered_share": share, "longest_repeat": longest, "base_failed": failed, "kept": ~failed & (share <= max_covered) & ~too_long}


def _judged(column: pa.Array, limits: dict) -> dict[str, np.ndarray]:
    """All columns for an Arrow column of texts, range by range."""
    data, offsets = T.utf8(column)
    got = [judge(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], **limits) for i, j in T.parts(offsets, RANGE_BYTES)]
    return {c: np.concatenate([g[c] for g in got]) for c in got[0]} if got else {}


def repetition_rules(df: DataFrame, *, max_covered: float = 0.30, longest_words: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and COLUMNS for every row.

    n_words; word_chars (code points in words); n_symbols (``[#*$%&|<>]``);
    n_dup_lines (lines with a word, equal to an earlier line); n_repeat_words
    (words in 8-word windows found twice or more); covered_share (of word
    bytes, by repeats); longest_repeat (words); base_failed (under 20 words, or
    over 30 in 100 words repeat); kept (not base_failed, and within both limits).
    """
    tune(df.sparkSession)
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    limits = {"max_covered": max_covered, "longest_words": longest_words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = _judged(b.column("__text"), limits)
            if got:
                yield pa.RecordBatch.from_arrays([b.column("__id"), *(pa.array(got[c]) for c in names)], ["__id", *names])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(run, f"__id {kind}, {COLUMNS}").withColumnRenamed("__id", id_col)


def keep_unrepeated(df: DataFrame, *, max_covered: float = 0.30, longest_words: int = 64, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with the columns they have."""
    tune(df.sparkSession)
    limits = {"max_covered": max_covered, "longest_words": longest_words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = _judged(b.column(text_col), limits)
            if got:
                yield b.filter(pa.array(got["kept"]))

    return df.mapInArrow(run, df.schema)
