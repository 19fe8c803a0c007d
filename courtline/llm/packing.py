"""Mixture-controlled packing (operator 3).

Every source is a queue of tokens.  Window after window, deficit round-robin
takes from each queue what its target share entitles it to; what integer
tokens can't pay is its deficit and is carried to the next window.  Carried
exactly, the deficits have a closed form: after window w a source with share
``num / den`` of ``window`` tokens has given ``floor(w * window * num / den)``
tokens (all it has, once its queue is empty).  So every window, on whatever
partition, knows its deficits without asking the one before.

Jobs: (1) tokenize once, write ids with each document's place in its source's
queue within its input partition; (2) sum tokens per (source, partition) and
prefix those sums per source; (3) cut every document where a window or a
sequence ends.  No text or token is shuffled.  The plan that goes to every
task has one entry per source.  With more than ``MAX_SOURCES`` the plan is a
table of the runs (source, window) instead, joined to the documents' fragments
(``_by_table``): the same pieces, but tokens are shuffled twice.

Without ``weights`` the targets are the sources' shares of the corpus, so all
queues end together and each window holds every source in proportion.  With
weights, a queue that has run out leaves its share to the others.

Defined cases: a null or empty text is the end id alone; a null source is a
source of its own; repeated rows are packed once each; an empty table gives no
pieces; extra columns are ignored.  Only the last sequence is not full.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.chunkcache import ChunkCache, cuts_before_space
from courtline.llm.store import stored, tune
from courtline.llm.token_counts import vocabulary

RANGE_BYTES = 8 << 20
#: Sources in the plan that goes to tasks; more are joined as a table.
MAX_SOURCES = 10_000
BATCH_ROWS = 10_000
#: Numbers of window plans that a task keeps: windows x sources.
PLAN_SIZE = 1_000_000
#: Windows whose starts are summed together.
BLOCK = 1024
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string, window_id bigint"

_CACHES: dict[str, tuple[ChunkCache, bool]] = {}
#: The printable stand-ins of bytes in a byte-level vocabulary: visible Latin-1 characters stand for themselves, the rest for U+0100 and up.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_STAND_IN = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _VISIBLE)}


#: How word_bpe_49k.json normalises and splits texts.
_WORDS = {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
          "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}


def _lower_case_words(tok) -> bool:
    """Whether a tokenizer lower-cases texts and takes their words one by one as byte-level BPE: then A-Z may be
    lower-cased first, and a word of letters is one pre-token."""
    about = json.loads(tok.to_str())
    split, level = ((about["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}])[:2]
    return (about["normalizer"] == _WORDS["normalizer"] and about["model"]["type"] == "BPE" and split.get("pattern") == {"Regex": _WORDS["pattern"]} and split.get("behavior") == "Removed"
            and level.get("type") == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"])


def _cache(name: str) -> tuple[ChunkCache, bool]:
    """A piece without its blanks that is made of ASCII and Latin-1 letters only
    is one pre-token, and goes to the library's BPE model at once; any other
    goes through the whole tokenizer, as does every piece of another
    kind of tokenizer (``_lower_case_words``, the second value)."""
    if name not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(vocabulary(name))
        tok.no_truncation()
        tok.no_padding()
        model, lower = tok.model, _lower_case_words(tok)

        def encode(pieces: list[bytes]) -> list:
            out, rest = [None] * len(pieces), []
            for k, p in enumerate(pieces):
                w = p.decode().strip(" \n")
                if lower and w.isalpha() and (w.isascii() or max(w) < "Ā" and min(filter(lambda c: c > "\x7f", w)) >= "À"):
                    w = w.lower()
                    if not w.isascii():
                        w = "".join(_STAND_IN[b] for b in w.encode())
                    out[k] = [t.id for t in model.tokenize(w)]
                else:
                    rest.append(k)
            if rest:
                for k, e in zip(rest, tok.encode_batch_fast([pieces[k].decode() for k in rest], add_special_tokens=False), strict=True):
                    out[k] = e.ids
            return out

        _CACHES[name] = ChunkCache(encode), lower
    return _CACHES[name]


def token_ids(column: pa.Array, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges [i, j) of the texts: their ids one after the other, and each text's offsets in them."""
    data, offsets = T.utf8(column)
    cache, lower = _cache(name)
    for i, j in T.parts(offsets, RANGE_BYTES):
        part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        if lower and b"<|" not in part.tobytes():  # a special string's spelling counts
            part = T.LOWER[part]
        starts = cuts_before_space(part, offs, marks=lower)
        slots = cache.find(part, starts, np.append(starts[1:], len(part)))
        sizes = np.concatenate([[0], np.cumsum(cache.sizes[slots], dtype=np.int64)])
        yield i, j, cache.ids(slots), sizes[T.per_text(starts, offs)]


def tokenized(df: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, source, part, place (of the document in its source's queue within the part), n, ids (uint16 or uint32)."""
    tune(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given = TaskContext.get().partitionId(), {}
        for b in batches:
            sources = b.column("source").to_pylist()
            for i, j, ids, at in token_ids(b.column("text"), tokenizer):
                n = np.diff(at) + 1
                whole = np.insert(ids, at[1:], end_id).astype("<u4").view(np.uint8)
                ends = np.concatenate([[0], np.cumsum(n) * 4])
                place = np.empty(j - i, np.int64)
                for k, (s, x) in enumerate(zip(sources[i:j], n.tolist(), strict=True)):
                    place[k] = given.get(s, 0)
                    given[s] = place[k] + x
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(i, j - i), b.column("source").slice(i, j - i), pa.array(np.full(j - i, part, np.int64)), pa.array(place), pa.array(n),
                    pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(whole)]).cast(pa.binary())],
                    ["doc_id", "source", "part", "place", "n", "ids"])

    return df.mapInArrow(run, "doc_id bigint, source string, part bigint, place bigint, n bigint, ids binary")


def given_until(w: np.ndarray, totals: np.ndarray, quota: np.ndarray, den: int) -> np.ndarray:
    """Tokens each source has given before window w: floor(w * quota / den), all it has at most.  Rows: w; columns: sources."""
    q, r = quota // den, quota % den
    w = np.asarray(w, np.int64)[:, None]
    return np.minimum(w * q + w * r // den, totals)


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of a schema of bigint, string and binary columns."""
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    types = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k] for k in kinds]
    while some := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some, strict=True), types, strict=True)], list(names))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _by_table(tokens: DataFrame, per_part: DataFrame, base: DataFrame, *, length: int, window: int, weights: dict[str, int] | None) -> DataFrame:
    """What pack() returns, for any number of sources: nothing that grows with them is held by the driver or a task."""
    totals = per_part.groupBy("source").agg(F.sum("n").alias("total"))
    if weights is None:
        den = max(1, -(-totals.agg(F.sum("total")).first()[0] // window))
        sources = totals.select("source", "total", F.col("total").alias("quota"))
    else:
        def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _batches(((s, total, max(0, int(weights.get(s, 1))) * window) for s, total in _read(batches)), "source string, total bigint, quota bigint")

        sources = totals.mapInArrow(shared, "source string, total bigint, quota bigint")
        least, quotas = sources.agg(F.min("quota"), F.sum("quota")).first()
        if least == 0:
            raise ValueError("a weight of 0 would never pack its source; leave those rows out instead")
        den = quotas // window

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for source, total, q in _read(batches):
                one, by, last = np.array([total]), np.array([q]), (total * den - 1) // q
                for lo in range(0, min(total, last + 1), BATCH_ROWS):
                    at = np.arange(lo, min(total, last + 1, lo + BATCH_ROWS))
                    # the windows one by one, or those that hold the source's tokens, if these are fewer
                    w = at if last < total else ((at + 1) * den - 1) // q
                    before, after = given_until(w, one, by, den)[:, 0], given_until(w + 1, one, by, den)[:, 0]
                    own = (after > before) & ((last < total) | (before == at))
                    yield from zip([source] * int(own.sum()), w[own].tolist(), (after - before)[own].tolist(), strict=True)
        return _batches(rows(), "source string, w bigint, run bigint")

    # where each run begins in the whole order: by window, then by source
    runs = sources.mapInArrow(runs_of, "source string, w bigint, run bigint")
    windows = runs.groupBy("w").agg(F.sum("run").alias("run")).withColumn("block", F.floor(F.col("w") / BLOCK))
    windows = windows.withColumn("in_block", F.sum("run").over(Window.partitionBy("block").orderBy("w")) - F.col("run"))
    blocks = windows.groupBy("block").agg(F.sum("run").alias("all")).select("block", (F.sum("all").over(Window.orderBy("block")) - F.col("all")).alias("to_block"))
    starts = windows.join(blocks, "block").select("w", (F.col("in_block") + F.col("to_block")).alias("start"))
    in_window = F.sum("run").over(Window.partitionBy("w").orderBy("source")) - F.col("run")
    begins = runs.withColumn("in_window", in_window).join(starts, "w").select("source", "w", (F.col("start") + F.col("in_window")).alias("begin"))

    fragment = "doc_id bigint, source string, w bigint, start bigint, past bigint, n bigint, ids binary"

    def fragments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc, source, first, n, ids, total, q in _read(batches):
                at = first
                while at < first + n:
                    w = ((at + 1) * den - 1) // q
                    until = min((w + 1) * q // den, total, first + n)
                    yield doc, source, w, at - first, at - w * q // den, n, ids[4 * (at - first):4 * (until - first)]
                    at = until
        return _batches(rows(), fragment)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc, source, w, start, past, n, ids, begin in _read(batches):
                at, place, end = 0, begin + past, len(ids) // 4
                while at < end:
                    size = min(end - at, length - place % length)
                    yield doc, start + at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n, place // length, place % length, source, w
                    at, place = at + size, place + size
        return _batches(rows(), PIECES)

    known = base.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select("b.source", "part", "base", "total", "quota")
    placed = tokens.alias("t").join(known.alias("k"), F.col("t.source").eqNullSafe(F.col("k.source")) & (F.col("t.part") == F.col("k.part")))
    fragments = placed.select("doc_id", "t.source", (F.col("place") + F.col("base")).alias("first"), "n", "ids", "total", "quota").mapInArrow(fragments_of, fragment)
    put = fragments.alias("f").join(begins.alias("g"), F.col("f.source").eqNullSafe(F.col("g.source")) & (F.col("f.w") == F.col("g.w")))
    return put.select("doc_id", "f.source", "f.w", "start", "past", "n", "ids", "begin").mapInArrow(cut, PIECES)


def pack(df: DataFrame, *, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, length: int = 4096, window: int = 64 * 4096,
         weights: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens (columns: PIECES).

    ``weights``: whole numbers by source, targets in proportion (sources not
    named get 1); by default each source's share of all tokens.
    """
    spark = df.sparkSession
    tokens = stored(tokenized(df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")), tokenizer, end_id), "pack-tokens")

    per_part = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    base = per_part.select("source", "part", (F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")).alias("base"))
    rows = per_part.groupBy("source").agg(F.sum("n").alias("n")).orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        return _by_table(tokens, per_part, base, length=length, window=window, weights=weights)
    names = [r["source"] for r in rows]
    totals = np.array([r["n"] for r in rows], np.int64)
    if weights is None:
        # n_windows windows in all; a source of n tokens gives floor(w * n / n_windows) before window w
        den = max(1, -(-int(totals.sum()) // window))
        quota = totals
    else:
        share = np.array([max(0, int(weights.get(s, 1))) for s in names], np.int64)
        if (share == 0).any():
            raise ValueError("a weight of 0 would never pack its source; leave those rows out instead")
        den, quota = int(share.sum()) if len(share) else 1, share * window

    index = {s: k for k, s in enumerate(names)}

    def window_plan(w: int, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each source has given before w and after w, and where its run of w begins in the whole order."""
        if w not in known:
            if (len(known) + 1) * len(totals) > PLAN_SIZE:
                known.clear()
            two = given_until([w, w + 1], totals, quota, den)
            run = two[1] - two[0]
            known[w] = two[0], two[1], int(two[0].sum()) + np.cumsum(run) - run
        return known[w]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            cols = [b.column(c).to_pylist() for c in ("doc_id", "source", "first", "n")]
            data = b.column("ids")
            for k, (doc, source, first, n) in enumerate(zip(*cols, strict=True)):
                ids, s = data[k].as_buffer(), index[source]
                at, q = first, int(quota[s])
                while at < first + n:
                    # the window that holds the queue's token `at`: the last w with given(w) <= at
                    w = ((at + 1) * den - 1) // q
                    before, after, begins = window_plan(w, known)
                    until, begin = min(int(after[s]), first + n), int(begins[s] + at - before[s])
                    while at < until:
                        size = min(until - at, length - begin % length)
                        a, z = 4 * (at - first), 4 * (at - first + size)
                        for to, x in zip(out, (doc, at - first, size, zlib.crc32(ids[a:z]), n, begin // length, begin % length, source, w), strict=True):
                            to.append(x)
                        at, begin = at + size, begin + size
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if c == 7 else pa.int64()) for c, x in enumerate(out)], [x.split()[0] for x in PIECES.split(", ")])

    placed = tokens.alias("t").join(base.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")) & (F.col("t.part") == F.col("b.part")))
    return placed.select("doc_id", "t.source", (F.col("place") + F.col("base")).alias("first"), "n", "ids").mapInArrow(cut, PIECES)
