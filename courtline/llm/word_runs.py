"""Periodic runs of words by a sparse diagonal recurrence (operator 13).

A run is a maximal stretch of words with smallest period q that is long enough:
words q apart are identical, and no neighbouring word goes on with that.  On
the diagonal of lag q, a run is an unbroken row of matches.

The recurrence goes over the words in order: where the words from i on were
seen before, that occurrence's lag is active and its match length grows by one;
where the lag ends or changes, the diagonal ends, and if the run is long
enough it is emitted.  Counting all earlier occurrences of a word would cost
the square of a frequent word's count, and a run's multiples of q would be
active too.  So lags are taken in scales: lags in (g/2, g], g a power of two,
are looked up by the g words from i on, and only the *nearest* earlier
occurrence counts.  That finds the same runs: a run of period q <= g < 2q holds
4q words or more, so g words from any place in it fit behind the first period;
they contain a whole primitive period, which recurs first at lag q.  (For the
same reason no other lag of that scale can last as long there.)  Work is
n log n for any text: places whose g words occur once are dropped before the
next scale.

Names of the g-word strings are made by doubling (pairs of names of half the
length), exact but for the 64-bit hash of a single word.

Defined cases: a null or empty text, or one of blanks, has no words and no
runs; a null id plants no period; repeated rows are judged one by one; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.store import tune

RANGE_BYTES = 2 << 20
#: A run has this many words or more, and this many periods or more.
LEAST_WORDS, LEAST_PERIODS = 6, 4
COLUMNS = "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key: its name (equal for equal keys) and the place before it that holds the same key (-1: none)."""
    by = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[by][1:] == keys[by][:-1]
    name, before = np.empty(len(keys), np.int64), np.full(len(keys), -1, np.int64)
    name[by] = np.cumsum(~same) - 1
    before[by[1:][same[1:]]] = by[:-1][same[1:]]
    return name, before


def find_runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``words``: a number for each word of several texts one after the other, no
    number in two texts.  ``ends``: for every word, where its text ends.
    """
    n = len(words)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    here, g = np.arange(n), 1                                      # places whose g words may recur
    keys = words
    while len(here):
        own, before = _names(keys)
        recurs = np.bincount(own)[own] > 1
        lag = np.zeros(n + 1, np.int64)
        again = np.flatnonzero(before >= 0)
        lag[here[again]] = here[again] - here[before[again]]
        lag[(lag <= g // 2) | (lag > g)] = 0
        # the match length of the active lag grows from place to place; here it ends
        border = np.flatnonzero(np.diff(lag, prepend=0))
        first, stop = border[:-1], border[1:]
        alive = lag[first] > 0
        first, stop = first[alive], stop[alive]
        period = lag[first]
        length = stop - first + g - 1 + period
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append((first[long] - period[long], length[long], period[long]))
        name = np.full(n, -1, np.int64)                            # of the g words from a place on; -1: they occur once
        name[here[recurs]] = own[recurs]
        # twice as many words: both halves recur, and four periods of over g words fit the text
        here = here[recurs]
        here = here[here + 2 * g <= ends[here]]
        here = here[name[here + g] >= 0]
        keys = name[here] * n + name[here + g]
        g *= 2
    start, length, period = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((),) * 3))
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def planted(n: int, h: int) -> tuple[int, int] | None:
    """(a, p): from word a on, the text repeats its next p words; None where the hash plants no period."""
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def judge(data: np.ndarray, offsets: np.ndarray, hashes: list[int | None]) -> list[list]:
    """COLUMNS of the texts of one range.  ``hashes``: what plants a period in each, if anything."""
    begins, stops = T.words(data, offsets)
    per = T.per_text(begins, offsets)
    sizes = np.diff(per)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(begins))
    changed = {}
    for k, (n, h) in enumerate(zip(sizes.tolist(), hashes, strict=True)):
        plan = planted(n, h) if h is not None else None
        if plan:
            a, p = plan
            place[per[k] + a:per[k + 1]] = per[k] + a + np.arange(n - a) % p
            changed[k] = True
    hashed = T.hash_spans(data, begins, stops)[place]
    # the same word in two texts is two words
    starts, lengths, periods = find_runs(_names(T.combine(hashed, doc.astype(np.uint64)))[0], per[1:][doc])
    of = doc[starts]
    run_at = np.searchsorted(of, np.arange(len(sizes) + 1)).tolist()
    delta = np.zeros(len(begins) + 1, np.int64)
    np.add.at(delta, starts + periods, 1)
    np.add.at(delta, starts + lengths, -1)
    kept = np.cumsum(delta[:-1]) == 0

    out: list[list] = [[] for _ in COLUMNS.split(", ")]
    whole = data.tobytes()
    for k, n in enumerate(sizes.tolist()):
        i, j = run_at[k], run_at[k + 1]
        words = whole[offsets[k]:offsets[k + 1]].split()
        runs = list(zip((starts[i:j] - per[k]).tolist(), lengths[i:j].tolist(), periods[i:j].tolist(), strict=True))
        if k in changed:
            words = [words[x] for x in (place[per[k]:per[k + 1]] - per[k]).tolist()]
        if runs:
            words = [w for w, stays in zip(words, kept[per[k]:per[k + 1]].tolist(), strict=True) if stays]
        best = None
        for run in runs:                                           # by start, then period: a tie keeps the earlier one
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        row = (n, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
               hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
        for column, value in zip(out, row, strict=True):
            column.append(value)
    return out


def word_runs(df: DataFrame, *, plant: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and COLUMNS for every row.

    start, length, period, exponent_milli: the run of greatest length / period
    (ties: smallest start, then period), null without a run.  runs_sha256: of
    ``start,length,period`` lines.  collapsed_sha256: of the words that no run
    holds after its first period, joined by a blank.  ``plant``: a whole number
    a row by which ``planted`` gives the text a period first (null: none).
    """
    tune(df.sparkSession)
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), (F.lit(None) if plant is None else plant).cast("bigint").alias("__plant"))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = [pa.int64() if c.endswith("bigint") else pa.string() for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.utf8(b.column("__text"))
            hashes = b.column("__plant").to_pylist()
            for i, j in T.parts(offsets, RANGE_BYTES):
                got = judge(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], hashes[i:j])
                yield pa.RecordBatch.from_arrays([b.column("__id").slice(i, j - i), *map(pa.array, got, kinds)], ["__id", *names])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(run, f"__id {kind}, {COLUMNS}").withColumnRenamed("__id", id_col)
