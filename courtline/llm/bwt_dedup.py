"""Removal of repeated byte strings by merging shards' Burrows-Wheeler transforms (operator 7).

A byte goes if some ``length``-byte string that covers it also starts earlier:
in a document with a smaller id, or earlier in the same document.

*Shards.*  Two equal strings of ``length`` bytes hold the same k-gram of least
hash at the same place, so only strings around such anchors can meet.  Anchors
that occur once in the corpus are dropped: one that occurs twice in a range of
texts is known to repeat at once, the others meet by their hash, one row a
range at most (so a passage that every text holds makes no hot key).  The
contexts of the repeated ones, as far as strings are theirs, are dealt out by
anchor.  What one map task sends is a shard: contexts aligned at their anchor,
whose suffixes from any column are comparable.

*Merge.*  A task takes the shards' contexts of its anchors and merges their
transforms by iterative interleave refinement: it holds one interleave, the
order of all suffixes that start at a column; the symbols before them (the
transform of that column) are dealt stably into buckets, which is the order at
the column before.  No suffix is compared or sorted anew.  The longest common
prefix of neighbours is carried along: one more than the least of those
between them, or none where their symbols differ.  Neighbours with a common
prefix of ``length`` or more bound an interval of equal strings; all of its
members but the earliest are repeats.

An anchor with over ``hot`` occurrences would make one task long.  Its strings
are resolved as rows instead (window hash, earliest start), with partial
aggregation on the map side.  Before either, equal contexts of a range of texts
are reduced to the earliest; they are found by a hash and compared byte by byte.

Defined cases: a null or empty text, or one under ``length`` bytes, loses
nothing; rows without an id come last; rows that share an id are ordered by a
hash of their texts, and rows alike in both are one document; matches never
cross documents; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.store import stored, tune

LENGTH = 100
GRAM = 16
HOT = 200_000
RANGE_BYTES = 2 << 20
#: Hashes of all positions are held for so many bytes at a time.
STEP_BYTES = 1 << 18
#: Contexts merged at once, but for an anchor that has more.
MERGE_ROWS = 30_000
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_LAST = (1 << 63) - 1


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from every position on, by doubling."""
    whole, done, power, width = None, 0, T.mix((data.astype(np.uint64) + np.uint64(1)) * _C[0]), 1
    while True:                                                  # the powers of two that make up size, smallest first
        if size & width:
            whole, done = (power, width) if whole is None else (_joined(power, whole, width, done), done + width)
        if done == size:
            return T.mix(whole * _C[1])
        power, width = _joined(power, power, width, width), 2 * width


def _joined(x: np.ndarray, y: np.ndarray, left: int, right: int) -> np.ndarray:
    """Hashes of ``left`` bytes followed by ``right`` bytes, from the hashes of both."""
    n = min(len(x), len(y) - left)
    both = x[:n] * _C[left.bit_length() % 7]
    both ^= both >> np.uint64(29)
    both += y[left:left + n]
    return both


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours."""
    step = 1
    while step * 2 <= width:
        x, step = op(x[:-step], x[step:]), step * 2
    return op(x[:len(x) - (width - step)], x[width - step:]) if step < width else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """K-grams that are least in some window of ``length`` bytes inside one text: their positions, hashes,
    and how many bytes before and behind them those windows reach."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty.astype(np.uint64), empty, empty
    full = gram_hashes(data, gram)
    short = (full >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    width = length - gram + 1
    least = _sliding(short, width, np.minimum)                   # by window start
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    least[np.arange(len(least)) + length > ends] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == short)
    # the windows of an anchor are one run of equal minima, the last such run that begins at the anchor or before
    heads = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    tails = np.append(heads[1:], len(least)) - 1
    run = np.searchsorted(heads, at, "right") - 1
    other = np.flatnonzero(least[heads[run]] != short[at])
    while len(other):
        run[other] -= 1
        other = other[least[heads[run[other]]] != short[at[other]]]
    first, last = np.maximum(heads[run], at - width + 1), np.minimum(tails[run], at)
    return at, full[at], at - first, last + length - at - gram


def _prepared(docs: DataFrame, tied: bool) -> DataFrame:
    """doc_id, dk (its place in the order), tie, z (the text's bytes, packed for the shuffle), rest (the other columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            data, offsets = T.utf8(b.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            each = [view[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc_id").fill_null(_LAST), _ties(each, tied), pa.array([pack.compress(x) for x in each], pa.binary()), b.column("rest")], ["doc_id", "dk", "tie", "z", "rest"])

    return docs.mapInArrow(run, f"doc_id bigint, dk bigint, tie bigint, z binary, rest {docs.schema['rest'].dataType.simpleString()}")


def _ties(each: list, tied: bool) -> pa.Array:
    """What orders texts that share an id; 0 where no id occurs twice."""
    return pa.array(np.array([xxhash.xxh3_64_intdigest(x) if tied else 0 for x in each], np.uint64).view(np.int64))


def _anchored(docs: DataFrame, length: int, gram: int, tied: bool, known: bool) -> DataFrame:
    """Anchors as rows fp, dk, tie, at (position, then the bytes before and behind, 8 bits each), many.

    ``known``: those that occur twice or more in their range of texts.  Else
    the single ones, and for each of the known a row without a document that
    counts them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.utf8(b.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            dk = b.column("doc_id").fill_null(_LAST).to_numpy()
            tie = _ties([view[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)] if tied else [b""] * b.num_rows, tied).to_numpy()
            for i, j in T.parts(offsets, RANGE_BYTES):
                offs = offsets[i:j + 1] - offsets[i]
                steps = [(offs[a], anchors(data[offsets[i] + offs[a]:offsets[i] + offs[z]], offs[a:z + 1] - offs[a], length, gram)) for a, z in T.parts(offs, STEP_BYTES)]
                at = np.concatenate([start + got[0] for start, got in steps])
                fp, before, behind = (np.concatenate([got[c] for _, got in steps]) for c in (1, 2, 3))
                doc = np.repeat(np.arange(i, j), np.diff(np.searchsorted(at, offs)))
                where = ((at - offs[doc - i]) << 16) | (before << 8) | behind
                by = np.argsort(fp, kind="stable")
                new = np.concatenate([[True], fp[by][1:] != fp[by][:-1]]) if len(fp) else np.zeros(0, bool)
                heads = np.flatnonzero(new)
                size = np.diff(np.append(heads, len(by)))
                mine = by[np.repeat(size, size) > 1] if known else by[np.repeat(size, size) == 1]
                cols = [pa.array(fp[mine].view(np.int64)), pa.array(dk[doc[mine]]), pa.array(tie[doc[mine]]), pa.array(where[mine]), pa.array(np.ones(len(mine), np.int64))]
                names = ["fp", "dk", "tie", "at", "many"]
                yield pa.RecordBatch.from_arrays(cols, names)
                if not known:
                    marks, none = fp[by[heads[size > 1]]].view(np.int64), pa.nulls(int((size > 1).sum()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(marks), none, none, none, pa.array(size[size > 1])], names)

    return docs.mapInArrow(run, "fp bigint, dk bigint, tie bigint, at bigint, many bigint")


def _repeated(rows: DataFrame, hot: int) -> DataFrame:
    """Of the single anchors those that occur elsewhere too (fp, dk, tie, at), and a row without a document for each anchor over ``hot``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks()
            fp, many = t["fp"].to_numpy(), t["many"].to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
            total = np.add.reduceat(many, heads)
            again = np.repeat(total > 1, np.diff(np.append(heads, len(fp))))
            keep = t.filter(pa.array(again & t["dk"].is_valid().to_numpy())).select(["fp", "dk", "tie", "at"])
            over = pa.array(fp[heads[total > hot]])
            none = pa.nulls(len(over), pa.int64())
            out = pa.concat_tables([keep, pa.table([over, none, none, none], names=["fp", "dk", "tie", "at"])]).combine_chunks()
            return out.to_batches()[0] if out.num_rows else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, ["fp", "dk", "tie", "at"])

        for b in batches:
            fp = b.column("fp").to_numpy()
            if not len(fp):
                continue
            cut = int(np.searchsorted(fp, fp[-1]))                # the last anchor may go on in the next batch
            if cut or held and held[-1].column("fp")[0].as_py() != fp[-1]:
                ready = [*held, b.slice(0, cut)] if cut else held
                yield done(ready)
                held = [b.slice(cut)]
            else:
                held.append(b)
        if held:
            yield done(held)

    return rows.repartition("fp").sortWithinPartitions("fp").mapInArrow(run, "fp bigint, dk bigint, tie bigint, at bigint")


def earliest(same: np.ndarray, order: tuple[np.ndarray, ...], starts: np.ndarray, left: np.ndarray, size: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(contexts that equal an earlier one, contexts that go on), given by number.

    ``same``: a hash that brings candidates together.  A context counts as equal to the first
    of its hash only if all bytes are (its anchor's included); one that merely shares the hash goes on.
    ``order``: what orders contexts, least weighty first; those alike in it are one row that is there twice.
    """
    by = np.lexsort((*order, same))
    new = np.ones(len(by), bool)
    new[1:] = same[by][1:] != same[by][:-1]
    head = by[new][np.cumsum(new) - 1]
    later = np.any([c[by] != c[head] for c in order], axis=0)
    x, h = by[later], head[later]
    equal = (left[x] == left[h]) & (size[x] == size[h])
    equal[equal] = T.same_spans(data, starts[x[equal]], starts[h[equal]], size[x[equal]])
    return x[equal], np.sort(np.concatenate([by[new], x[~equal]]))


def _contexts(found: DataFrame, gram: int) -> DataFrame:
    """fp, dk, tie, at, l (bytes before the anchor), hot, s: the bytes before and behind each repeated anchor, as far as its windows reach.

    Of equal contexts in a range of texts the earliest goes on.  All strings of the others are repeats, so those come as rows
    without s that say what to remove (l bytes from at), under a key of their own that spreads them.
    """

    names = ["fp", "dk", "tie", "at", "l", "hot", "s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            own, packed = b.column("own"), b.column("z").to_pylist()
            flat, sizes = own.flatten(), own.value_lengths().to_numpy()
            fp, at, hot = (flat.field(c) for c in ("fp", "at", "hot"))
            place = at.to_numpy()
            first, k = 0, 0
            while k < len(packed):
                texts, size, k0 = [], 0, k
                while k < len(packed) and size < RANGE_BYTES:
                    texts.append(unpack.decompress(packed[k]))
                    size, k = size + len(texts[-1]), k + 1
                n = int(sizes[k0:k].sum())
                base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                row = np.repeat(np.arange(k0, k), sizes[k0:k])
                here = place[first:first + n]
                p, left, right = here >> 16, (here >> 8) & 0xFF, here & 0xFF
                start = base[row - k0] + p
                data = np.frombuffer(b"".join(texts), np.uint8)
                same = T.combine(T.hash_spans(data, start - left, start), T.hash_spans(data, start + gram, start + gram + right), fp.slice(first, n).to_numpy().view(np.uint64))
                dk, tie = (b.column(c).to_numpy()[row] for c in ("dk", "tie"))
                again, kept = earliest(same, (p, tie, dk), start - left, left, left + gram + right, data)
                if len(again):
                    spread = T.mix(dk[again].view(np.uint64) + p[again].view(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(dk[again]), pa.array(tie[again]), pa.array((p - left)[again]), pa.array((left + gram + right)[again].astype(np.int32)), pa.array(np.zeros(len(again), bool)), pa.nulls(len(again), pa.binary())], names)
                for c in range(0, len(kept), 4096):              # bounds an output batch
                    z = kept[c:c + 4096]
                    begins = np.stack([start[z] - left[z], start[z] + gram], 1).ravel()
                    out = data[T.take_ranges(begins, np.stack([left[z], right[z]], 1).ravel())]
                    offs = np.concatenate([[0], np.cumsum(left[z] + right[z])]).astype(np.int32)
                    own_rows = pa.array(z + first)
                    yield pa.RecordBatch.from_arrays([
                        fp.take(own_rows), pa.array(dk[z]), pa.array(tie[z]), pa.array(p[z]), pa.array(left[z].astype(np.int32)), hot.take(own_rows),
                        pa.Array.from_buffers(pa.binary(), len(z), [None, pa.py_buffer(offs), pa.py_buffer(out)])], names)
                first += n

    return found.mapInArrow(run, "fp bigint, dk bigint, tie bigint, at bigint, l int, hot boolean, s binary")


def merge(fp: np.ndarray, rank: np.ndarray, left: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which strings repeat: [d, i] for the string that starts d bytes before the anchor of context i.

    ``fp``: sorted.  ``rank``: the contexts' places in the order of documents
    and positions.  ``left``: bytes a context has before its anchor; those
    behind it follow at once, the anchor itself is left out.
    """
    n, reach = len(fp), length - gram
    group = np.cumsum(np.concatenate([[0], (fp[1:] != fp[:-1]).astype(np.int64)])) << 9
    anchor = offsets[:-1] + left
    right = np.diff(offsets) - left
    out = np.zeros((reach + 1, n), bool)
    order = np.arange(n)                                          # the interleave: shard after shard, by anchor
    lcp = np.zeros(n + 1, np.int32)

    def refine(column: int) -> None:
        """From the order of the suffixes after ``column`` (counted from the anchor's end, before it below 0) to that of those from it on."""
        nonlocal order, lcp
        has = column < right if column >= 0 else -column <= left
        symbol = data[np.clip(anchor + column, 0, len(data) - 1)].astype(np.int64)
        symbol[~has] = 256
        symbol = symbol[order]
        key = group[order] | symbol
        to = np.argsort(key, kind="stable")
        key, symbol, order = key[to], symbol[to], order[to]
        new = np.zeros(n + 1, np.int32)
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[1:] < 256)) + 1   # a missing symbol equals nothing
        p, q = to[same - 1], to[same]
        value = lcp[q]
        wide = np.flatnonzero(q > p + 1)
        if len(wide):
            pairs = np.empty(2 * len(wide), np.int64)
            pairs[::2], pairs[1::2] = p[wide] + 1, q[wide] + 1
            value[wide] = np.minimum.reduceat(lcp, pairs)[::2]
        new[same] = value + 1
        lcp = new

    # before the first column every suffix is empty and equals its neighbour so far
    for column in range(reach - 1, -1, -1):
        refine(column)
    lcp[:-1][1:] += gram * (fp[order][1:] == fp[order][:-1])      # the anchor itself: equal throughout a group
    for d in range(reach + 1):
        if d:
            refine(-d)
        tied = lcp[:n] >= length
        if tied.any():
            heads = np.flatnonzero(~tied)
            by = rank[order]
            first = np.repeat(np.minimum.reduceat(by, heads), np.diff(np.append(heads, n)))
            out[d, order] = by > first
    return out


def _runs(flags: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the byte ranges that the flagged strings cover."""
    pad = np.zeros((1, flags.shape[1]), bool)
    change = np.diff(np.concatenate([pad, flags, pad]).astype(np.int8), axis=0)
    who, lo = np.nonzero(change.T == 1)
    _, hi = np.nonzero(change.T == -1)                            # strings start lo .. hi - 1 bytes before the anchor
    return who, at[who] - hi + 1, at[who] - lo + length


def _merged(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """dk, tie, x, z: byte ranges [x, z) to remove."""

    def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        said = t.filter(t["s"].is_null())
        t = t.filter(t["s"].is_valid()).combine_chunks()
        done = [said[c].to_numpy().astype(np.int64) for c in ("dk", "tie", "at", "l")]
        done[3] = done[2] + done[3]
        if not t.num_rows:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in done], ["dk", "tie", "x", "z"])
        dk, tie, at = (t[c].to_numpy() for c in ("dk", "tie", "at"))
        by = np.lexsort((at, tie, dk))
        new = np.ones(len(by), np.int64)
        new[1:] = (dk[by][1:] != dk[by][:-1]) | (tie[by][1:] != tie[by][:-1]) | (at[by][1:] != at[by][:-1])
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(new)
        s = t["s"].combine_chunks()
        s = s if isinstance(s, pa.Array) else s.chunk(0)
        offsets = np.frombuffer(s.buffers()[1], np.int32)[s.offset:s.offset + len(s) + 1].astype(np.int64)
        data = np.frombuffer(s.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        flags = merge(t["fp"].to_numpy(), rank, t["l"].to_numpy().astype(np.int64), data, offsets - offsets[0], length, gram)
        who, x, z = _runs(flags, at, length)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip((dk[who], tie[who], x, z), done, strict=True)], ["dk", "tie", "x", "z"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, MERGE_ROWS))
                b, count = b.slice(MERGE_ROWS), count + held[-1].num_rows
                if count < MERGE_ROWS:
                    continue
                fp = held[-1].column("fp").to_numpy()
                cut = int(np.searchsorted(fp, fp[-1]))            # where the last anchor, which may go on, begins
                if cut == 0 and held[0].column("fp")[0].as_py() == fp[-1]:
                    continue
                last = held.pop()
                ready = [*held, last.slice(0, cut)]
                if cut == 0:                                      # the last anchor began in an earlier batch
                    back = []
                    while ready and ready[-1].num_rows and ready[-1].column("fp")[-1].as_py() == fp[-1]:
                        x = ready.pop()
                        c = int(np.searchsorted(x.column("fp").to_numpy(), fp[-1]))
                        back.insert(0, x.slice(c))
                        if c:
                            ready.append(x.slice(0, c))
                            break
                        while ready and not ready[-1].num_rows:
                            ready.pop()
                    held = [*back, last]
                else:
                    held = [last.slice(cut)]
                ready = [x for x in ready if x.num_rows]
                if ready:
                    yield work(ready)
                count = sum(x.num_rows for x in held)
        if held:
            yield work(held)

    return contexts.repartition("fp").sortWithinPartitions("fp").mapInArrow(run, "dk bigint, tie bigint, x bigint, z bigint")


def _as_rows(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for hot anchors: every string of a context as a row, the earliest start by its hash."""
    size = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for fp, dk, tie, at, left, s in zip(*(b.column(c).to_pylist() for c in ("fp", "dk", "tie", "at", "l", "s")), strict=True):
                m = max(0, len(s) - size + 1)                     # strings start left, left - 1, ... bytes before the anchor
                if not m:
                    continue
                got = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b"%d %d " % (fp, left - k) + s[k:k + size]) for k in range(m)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1])), pa.array(np.full(m, dk)), pa.array(np.full(m, tie)), pa.array(at - left + np.arange(m))], ["h1", "h2", "dk", "tie", "x"])

    rows = contexts.mapInArrow(run, "h1 bigint, h2 bigint, dk bigint, tie bigint, x bigint")
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("dk", "tie", "x")).alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    return rows.join(first, ["h1", "h2"]).filter(F.struct("dk", "tie", "x") > F.col("first")).select("dk", "tie", "x", (F.col("x") + length).alias("z"))


def remove_repeats(df: DataFrame, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that stay) of every row; ``with_text``: also
    kept_text (characters that a cut has split are left out) and rest (a struct of the row's other columns)."""
    tune(df.sparkSession)
    other = [F.col(f"`{c}`") for c in df.columns if with_text and c not in (id_col, text_col)]
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (F.struct(*other) if other else F.lit(True)).alias("rest"))
    key, plain = F.coalesce("doc_id", F.lit(_LAST)).alias("dk"), docs.select("doc_id", "text")
    tied = not docs.select(key).groupBy("dk").count().filter("count > 1").isEmpty()
    twice = stored(_repeated(_anchored(plain, length, gram, tied, known=False), hot), "repeated")
    over = twice.filter("dk is null").select("fp", F.lit(True).alias("hot"))
    any_hot = not over.isEmpty()
    places = twice.filter("dk is not null").unionByName(_anchored(plain, length, gram, tied, known=True).drop("many"))
    places = places.join(over, "fp", "left").withColumn("hot", F.coalesce("hot", F.lit(False))) if any_hot else places.withColumn("hot", F.lit(False))
    own = places.groupBy("dk", "tie").agg(F.collect_set(F.struct("fp", "at", "hot")).alias("own"))  # as many as the text has anchors

    texts = _prepared(docs, tied)
    # both joins read the same shuffle of the texts
    contexts = _contexts(texts.join(own, ["dk", "tie"]).select("doc_id", "dk", "tie", "z", "rest", "own"), gram)
    cold = _merged(contexts.filter(~F.col("hot")).drop("hot"), length, gram)
    ranges = cold
    if any_hot:
        ranges = ranges.unionByName(_as_rows(contexts.filter("hot").drop("hot"), length, gram))
    ranges = ranges.groupBy("dk", "tie").agg(F.collect_set(F.struct("x", "z")).alias("ranges"))

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text", "rest"] * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[list] = [[] for _ in range(4 + with_text)]
            lists = b.column("ranges")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).tolist()
            flat = lists.flatten()
            xs, zs = (flat.field(c).to_numpy() for c in ("x", "z"))
            first = 0
            for z, m in zip(b.column("z").to_pylist(), sizes, strict=True):
                text = unpack.decompress(z)
                kept, removed, spans = text, 0, 0
                if m:
                    by = np.argsort(xs[first:first + m])
                    x, e = xs[first:first + m][by], np.maximum.accumulate(zs[first:first + m][by])
                    new = np.concatenate([[True], x[1:] > e[:-1]])
                    begin, end = x[new], e[np.append(np.flatnonzero(new)[1:] - 1, m - 1)]
                    spans, removed = len(begin), int((end - begin).sum())
                    parts = zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True)
                    kept = b"".join(text[p:q] for p, q in parts)
                first += m
                row = (len(text), removed, spans, hashlib.sha256(kept).hexdigest()) + ((kept.decode("utf-8", "ignore"),) if with_text else ())
                for to, v in zip(out, row, strict=True):
                    to.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, k) for v, k in zip(out, kinds, strict=False)), *[b.column("rest")] * with_text], names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += f", kept_text string, rest {docs.schema['rest'].dataType.simpleString()}"
    return texts.join(ranges, ["dk", "tie"], "left").select("doc_id", "z", "rest", "ranges").mapInArrow(cut, schema)


def without_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, **options) -> DataFrame:
    """Every row with the columns it has, the text less its repeats (a null text comes back empty), and ``chars_col`` the length of that."""
    done = remove_repeats(df, id_col=id_col, text_col=text_col, with_text=True, **options)
    new = {id_col: F.col("doc_id").cast(df.schema[id_col].dataType), text_col: F.col("kept_text")}
    if chars_col:
        new[chars_col] = F.length("kept_text").cast(df.schema[chars_col].dataType)
    return done.select(*(new[c].alias(c) if c in new else F.col("rest")[c].alias(c) for c in df.columns))
