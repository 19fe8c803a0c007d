"""Near duplicates by chosen-path set similarity join (operator 9).

A document's set is its distinct word shingles.  Documents with equal sets are
one class from the start.  A class is described by ``COORDS`` minwise tokens.
In every tree, a node picks one or two of these coordinates by a hash of its
path (1 / similarity of them on average) and its members branch by the token
they hold there.  Nodes of up to ``LEAF`` members are compared exhaustively on
the short sketch; larger ones branch on, up to ``DEPTH`` levels.  The trees draw
from the same coordinates, so their number is what ``recall`` of a pair at the
very threshold takes on average over the coordinates that such a pair agrees on.

Members of a node that is still large at ``DEPTH`` are mostly copies of few
texts.  They are compared within blocks of ``BLOCK``, one in ``THIN`` of them
(by hash) in blocks mixed anew, one in ``THIN ** 2`` again, until a block holds
all that are left of a node.  What that leaves apart is compared exactly in the
second round (below): members outside of the node's largest component with each
other and with the rest, as pairs of blocks.  A node of m members of which o
are outside then costs m * (1 + o / BLOCK) rows and m * (BLOCK + o)
comparisons: in proportion to m for copies of a text, m * m only where most of
a node is linked to nothing.

Every link is confirmed on the full sets.  Only connectivity is asked for, so
there are two rounds.  First, each node's maximum spanning forest on the
sketches is confirmed, pair by pair.  Then, in each node whose members are left
in different components although their sketches say that they may be linked,
those members' full sets are compared with each other where they meet, and only
a forest of the links between components leaves the task, never their pairs.

Defined cases: a null or empty text, or one without words, has an empty set,
is linked with nothing and kept; with fewer words than a shingle, the whole
sequence is the one shingle; rows without an id are linked with nothing, have
no component and are kept; rows that share an id are one document with several
texts; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm import textops as T
from courtline.llm.components import components
from courtline.llm.store import stored, tune

COORDS = 128
LEAF = 256
BLOCK = 512
DEPTH = 4
THIN = 8
#: Standard deviations of the sketch's estimate by which a pair may fall short of the threshold and still be confirmed.
MARGIN = 4.0
RANGE_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 1 << 32, COORDS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, COORDS, dtype=np.uint64).astype(np.uint32)


def survival(similarity: float, depth: int, agree: float | None = None) -> float:
    """The probability that a pair shares a node at ``depth`` in one tree built for ``similarity`` (one coordinate, or two with the probability that makes 1 / similarity on average), if it agrees on the share ``agree`` of the coordinates."""
    two, a, s = 1 / similarity - 1, similarity if agree is None else agree, 1.0
    for _ in range(depth):
        s = (1 - two) * a * s + two * (1 - (1 - a * s) ** 2)
    return s


def forks(keys: np.ndarray, similarity: float) -> np.ndarray:
    """Which nodes branch by two coordinates."""
    return (T.mix(keys.copy()) >> np.uint64(40)).astype(np.float64) / float(1 << 24) < 1 / similarity - 1


def missed(similarity: float, trees: int, depth: int = DEPTH) -> float:
    """How likely a pair at the very threshold is never compared by the first ``trees`` trees: over the coordinates it agrees on, which all trees share, and with those too few to pass the sketch."""
    two = int(forks(np.arange(1, trees + 1, dtype=np.uint64), similarity).sum())    # every pair has the same roots
    out = 0.0
    for k in range(COORDS + 1):
        chance = math.comb(COORDS, k) * similarity ** k * (1 - similarity) ** (COORDS - k)
        apart = 1 - k / COORDS * survival(similarity, depth - 1, k / COORDS)
        out += chance * (apart ** (trees + two) if k >= _least_match(similarity) else 1)
    return out


def trees_needed(similarity: float, recall: float, depth: int = DEPTH) -> int:
    """The fewest trees that miss a pair at the threshold with at most 1 - recall."""
    for trees in range(1, 1000):
        if missed(similarity, trees, depth) <= 1 - recall:
            return trees
    raise ValueError(f"sketches of {COORDS} coordinates don't allow a recall of {recall}")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``)."""
    low = T.LOWER[data]
    starts, ends = T.words(low, offsets)
    w = T.hash_spans(low, starts, ends)
    per = T.per_text(starts, offsets)
    if len(w) >= size:
        grams = T.combine(*(w[k:len(w) - size + 1 + k] for k in range(size)))
    for a, b in zip(per[:-1].tolist(), per[1:].tolist(), strict=True):
        if b - a >= size:
            g = np.sort(grams[a:b - size + 1])
            yield g[np.concatenate([[True], g[1:] != g[:-1]])]
        elif b > a:
            yield T.combine(np.array([b - a], np.uint64), *(w[k:k + 1] for k in range(a, b)))
        else:
            yield np.zeros(0, np.uint64)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest token under each of COORDS hash functions."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(out, (_MUL[:, None] * x[None, k:k + 2048] + _ADD[:, None]).min(1), out=out)
    return out


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), k1 and k2 (128 bits that name the set), coords (COORDS uint32), sketch (their low bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.utf8(b.column("text"))
            n, keys, coords, sketch = [], [], [], []
            for i, j in T.parts(offsets, RANGE_BYTES):
                for s in shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size):
                    n.append(len(s))
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    c = minwise(s)
                    coords.append(c.tobytes())
                    sketch.append(c.astype(np.uint8).tobytes())
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1])), pa.array(coords, pa.binary()), pa.array(sketch, pa.binary())], ["doc_id", "n", "k1", "k2", "coords", "sketch"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, k1 bigint, k2 bigint, coords binary, sketch binary")


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """A column of equally long binaries as rows."""
    data = column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind).reshape(len(column), width)


def branch(keys: np.ndarray, coords: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes ``keys`` that the rows of ``coords`` go to: (child keys, rows)."""
    h = T.mix(keys.copy())
    first = (h % np.uint64(COORDS)).astype(np.int64)
    second = (first + 1 + ((h >> np.uint64(16)) % np.uint64(COORDS - 1)).astype(np.int64)) % COORDS
    two = forks(keys, similarity)
    rows = np.arange(len(keys))
    rows, at = np.concatenate([rows, rows[two]]), np.concatenate([first, second[two]])
    return T.combine(keys[rows], at.astype(np.uint64), coords[rows, at].astype(np.uint64)), rows


def _branched(frontier: DataFrame, similarity: float, trees: int | None) -> DataFrame:
    """(node, rep) of the next level; the first level starts ``trees`` roots for every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coords = _matrix(b.column("coords"), COORDS, "<u4")
            reps = b.column("rep").to_numpy()
            roots = [np.full(len(reps), t + 1, np.uint64) for t in range(trees)] if trees else [b.column("node").to_numpy().view(np.uint64)]
            for keys in roots:
                node, rows = branch(keys, coords, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(reps[rows])], ["node", "rep"])

    return frontier.mapInArrow(run, "node bigint, rep bigint")


def _units(classes: DataFrame, similarity: float, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """(unit, rep): the groups to compare exhaustively; and (node, rep, size) of the nodes over BLOCK at DEPTH, None if there are none."""
    found, deep, level = [], None, _branched(classes, similarity, trees)
    for depth in range(1, DEPTH + 1):
        level = stored(level, "paths")
        size = level.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        level = level.join(size, "node")
        whole = F.col("size") <= (BLOCK if depth == DEPTH else LEAF)
        found.append(level.filter(whole).select(F.col("node").alias("unit"), "rep"))
        large = stored(level.filter(~whole), "paths")
        if large.isEmpty():
            break
        if depth == DEPTH:
            deep = large
        else:
            level = _branched(large.join(classes.select("rep", "coords"), "rep").select("node", "rep", "coords"), similarity, None)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out, deep


def _block_of(blocks: Column, *by: str | Column) -> Column:
    return F.pmod(F.xxhash64("rep", *by), blocks)


def _thinned(deep: DataFrame) -> DataFrame:
    """(unit, rep): blocks of each node's members, of one in THIN of them, of one in THIN ** 2, to the block that holds all that are left."""
    last = F.ceil(F.log(float(THIN), F.col("size") / BLOCK))
    stays = F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda t: F.when(F.pmod(F.xxhash64("rep"), F.pow(F.lit(THIN), t).cast("bigint")) == 0, t))
    rows = deep.select("node", "rep", "size", F.explode(F.array_compact(stays)).alias("turn"))
    blocks = F.ceil(F.col("size") / (F.pow(F.lit(THIN), F.col("turn")) * BLOCK))
    return rows.select(F.xxhash64("node", "turn", _block_of(blocks, "turn")).alias("unit"), "rep")


def _left_apart(deep: DataFrame, known: DataFrame) -> DataFrame:
    """(unit, rep): blocks of the members outside of their node's largest component, each with each and with all blocks of that component.  known: node, component."""
    placed = deep.select("node", "rep").join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    held = placed.groupBy("node", "component").agg(F.count("*").alias("held"))
    sizes = held.groupBy("node").agg(F.max_by("component", F.struct("held", "component")).alias("largest"), F.max("held").alias("most"), F.sum("held").alias("size")).filter("size > most")
    blocks = sizes.select("node", "largest", F.ceil((F.col("size") - F.col("most")) / BLOCK).alias("outer"), F.ceil(F.col("most") / BLOCK).alias("inner"))
    parted = stored(placed.join(blocks, "node").withColumn("main", F.col("component") == F.col("largest")), "parted")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    outside, inside = parted.filter("not main").withColumn("own", _block_of(F.col("outer"))), parted.filter("main").withColumn("own", _block_of(F.col("inner")))
    among = outside.select("node", "rep", "own", each("outer").alias("other")).select(F.xxhash64("node", F.lit(0), F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "rep")
    out = outside.select("node", "rep", "own", each("inner").alias("other")).select(F.xxhash64("node", F.lit(1), "own", "other").alias("unit"), "rep")
    into = inside.select("node", "rep", "own", each("outer").alias("other")).select(F.xxhash64("node", F.lit(1), "other", "own").alias("unit"), "rep")
    return among.unionByName(out).unionByName(into)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole units, several at once, of rows sorted by unit: (unit, rep, n, component, sketch)."""
    held: list[tuple] = []
    for b in batches:
        if not b.num_rows:
            continue
        now = (b.column("unit").to_numpy(), b.column("rep").to_numpy(), b.column("n").to_numpy(), b.column("component").to_numpy(), _matrix(b.column("sketch"), COORDS, "u1"))
        unit = now[0]
        if held and held[-1][0][-1] == unit[0] and unit[0] == unit[-1]:
            held.append(now)
            continue
        cut = int(np.flatnonzero(unit == unit[-1])[0])
        if held and (cut or held[-1][0][-1] != unit[0]):
            yield tuple(np.concatenate(x) for x in zip(*held, tuple(c[:cut] for c in now), strict=True))
            held = [tuple(c[cut:] for c in now)]
        else:
            if cut:
                yield tuple(c[:cut] for c in now)
            held = [tuple(c[cut:] for c in now)]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _forest(match: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of a matrix of weights (0: no edge)."""
    m = len(match)
    best, to, out, edges = np.full(m, -1), np.zeros(m, np.int64), np.ones(m, bool), []
    for _ in range(m):
        k = int(np.where(out, best, -2).argmax())
        out[k] = False
        if best[k] > 0:
            edges.append((int(to[k]), k))
        better = out & (match[k] > best)
        best[better], to[better] = match[k][better], k
    return edges


def _similar(n: np.ndarray, similarity: float) -> np.ndarray:
    """Which sizes allow the similarity."""
    return np.minimum(n[:, None], n[None]) >= similarity * np.maximum(n[:, None], n[None])


def _matches(sketch: np.ndarray) -> np.ndarray:
    m = len(sketch)
    out = np.zeros((m, m), np.int16)
    for k in range(0, m, 64):                                    # bounds the three-dimensional comparison
        for z in range(0, m, 256):
            out[k:k + 64, z:z + 256] = (sketch[k:k + 64, None, :] == sketch[None, z:z + 256, :]).sum(2)
    return out


def _least_match(similarity: float) -> int:
    return math.floor(COORDS * (similarity - MARGIN * math.sqrt(similarity * (1 - similarity) / COORDS)))


def _by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit", "rep")


def _candidates(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) to confirm: a forest of each unit.  rows: unit, rep, n, component, sketch."""
    least = _least_match(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rep, n, _, sketch in _groups(batches):
            heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            sizes = np.diff(np.append(heads, len(unit)))
            two = heads[sizes == 2]                              # most units: both members next to each other
            ok = (sketch[two] == sketch[two + 1]).sum(1) >= least
            ok &= np.minimum(n[two], n[two + 1]) >= similarity * np.maximum(n[two], n[two + 1])
            a, b = [rep[two[ok]]], [rep[two[ok] + 1]]
            for h, m in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                match = _matches(sketch[h:h + m])
                match[(match < least) | ~_similar(n[h:h + m], similarity)] = 0
                pairs = np.array(_forest(match), np.int64).reshape(-1, 2)
                a.append(rep[h:h + m][pairs[:, 0]])
                b.append(rep[h:h + m][pairs[:, 1]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return _by_unit(rows.select("unit", "rep", "n", "component", "sketch")).mapInArrow(run, "a bigint, b bigint").filter("a < b").distinct()


def _open(rows: DataFrame, similarity: float) -> DataFrame:
    """(unit, rep, component) of members that may be linked to another component of their unit."""
    least = _least_match(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rep, n, component, sketch in _groups(batches):
            heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            sizes = np.diff(np.append(heads, len(unit)))
            hit = np.zeros(len(unit), bool)
            for h, m in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                c = component[h:h + m]
                hit[h:h + m] = ((_matches(sketch[h:h + m]) >= least) & (c[:, None] != c[None]) & _similar(n[h:h + m], similarity)).any(1)
            yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (unit, rep, component)], ["unit", "rep", "component"])

    return _by_unit(rows.select("unit", "rep", "n", "component", "sketch")).mapInArrow(run, "unit bigint, rep bigint, component bigint")


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two sets share."""
    m = len(sets)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    every = np.concatenate(sets)
    by = np.argsort(every, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], every[by][1:] != every[by][:-1]]))
    counts = np.diff(np.append(heads, len(by)))
    who = who[by]
    out = np.zeros((m, m), np.float32)
    # what few sets hold is counted pair by pair, what many hold as products of columns
    for c in np.unique(counts[(counts > 1) & (counts < 16)]).tolist():
        block = who[heads[counts == c][:, None] + np.arange(c)]
        for i in range(c):
            for j in range(c):
                np.add.at(out, (block[:, i], block[:, j]), 1)
    many = heads[counts >= 16]
    if len(many):
        sizes = counts[counts >= 16]
        for k in range(0, len(many), 4096):
            part = np.zeros((m, min(4096, len(many) - k)), np.float32)
            width = sizes[k:k + 4096]
            part[who[T.take_ranges(many[k:k + 4096], width)], np.repeat(np.arange(len(width)), width)] = 1
            out += part @ part.T
    return out


def _settled(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) between components, by full sets: a forest of each unit.  rows: unit, rep, component, members (a sorted set)."""
    num, den = similarity

    def unit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rep, c = (np.concatenate([h.column(x).to_numpy() for h in held]) for x in ("rep", "component"))
        sets = [np.frombuffer(x, np.uint64) for h in held for x in h.column("members").to_pylist()]
        n, common = np.array([len(s) for s in sets], np.int64), shared(sets)
        linked = (den * common >= num * (n[:, None] + n[None] - common)) & (c[:, None] != c[None])
        pairs = np.array(_forest(linked.astype(np.int16)), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(c[pairs[:, 0]]), pa.array(c[pairs[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            names = b.column("unit").to_numpy()
            heads = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for s, e in zip(heads[:-1], heads[1:], strict=True):
                if s == e:
                    continue
                if held and held[-1].column("unit")[0].as_py() != names[s]:
                    yield unit(held)
                    held = []
                held.append(b.slice(s, e - s))
        if held:
            yield unit(held)

    return _by_unit(rows).mapInArrow(run, "a bigint, b bigint").distinct()


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """rep and members, its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.utf8(b.column("text"))
            sets = [s.tobytes() for i, j in T.parts(offsets, RANGE_BYTES) for s in shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)]
            yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array(sets, pa.binary())], ["rep", "members"])

    return texts.mapInArrow(run, "rep bigint, members binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough.  texts: one row (rep, text) for every class."""
    num, den = similarity
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    need = texts.join(wanted, "rep", "left_semi")
    both = pairs.join(need.select(F.col("rep").alias("a"), F.col("text").alias("x")), "a").join(need.select(F.col("rep").alias("b"), F.col("text").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                x, y = (shingle_sets(*T.utf8(part.column(c)), size) for c in ("x", "y"))
                for p, q in zip(x, y, strict=True):
                    # both are sorted and distinct: what meets itself in the merged order is in both
                    merged = np.sort(np.concatenate([p, q]))
                    common = int((merged[1:] == merged[:-1]).sum())
                    keep.append(den * common >= num * (len(p) + len(q) - common) and common > 0)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, *, shingle: int = 4, similarity: tuple[int, int] = (80, 100), recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id) of every row."""
    tune(df.sparkSession)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    level = similarity[0] / similarity[1]
    signed = stored(signatures(docs, shingle), "signatures")
    linkable = signed.filter("n > 0 and doc_id is not null")
    named = linkable.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    named = stored(named, "classes")
    classes = stored(linkable.join(named, ["k1", "k2"]).filter("doc_id = rep").dropDuplicates(["k1", "k2"]).select("rep", "n", "coords", "sketch"), "classes")

    units, deep = _units(classes, level, trees_needed(level, recall))
    known = classes.select("rep", "n", "sketch")
    # rows that repeat an id are one document: each of its texts is compared
    texts = docs.join(named.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "text").distinct()

    units = stored(units, "units")
    rows = (units if deep is None else units.unionByName(_thinned(deep))).join(known, "rep").withColumn("component", F.col("rep"))
    pairs = stored(_candidates(rows, level), "pairs")
    links = stored(_confirmed(pairs, texts, shingle, similarity), "links")
    first = stored(components(links), "components")

    # what the first round's links leave apart within a unit
    units = units.withColumn("met", F.lit(True))
    if deep is not None:
        units = units.unionByName(_left_apart(deep, first).withColumn("met", F.lit(False)))
    placed = units.join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = placed.groupBy("unit").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"), F.first("met").alias("met"))
    apart = apart.filter("x < y and (m > 2 or not met)").select("unit")           # of two that met, the forest was all
    left = stored(_open(placed.join(apart, "unit", "left_semi").join(known, "rep"), level), "open")
    need = texts.join(left.select("rep").distinct(), "rep", "left_semi")
    second = components(_settled(left.join(_sets(need, shingle), "rep").select("unit", "rep", "component", "members"), similarity))

    out = signed.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    out = out.join(first.select(F.col("node").alias("rep"), F.col("component").alias("c1")), "rep", "left").withColumn("c1", F.coalesce("c1", "rep", "doc_id"))
    out = out.join(second.select(F.col("node").alias("c1"), F.col("component").alias("c2")), "c1", "left")
    component = F.when(F.col("n") > 0, F.coalesce("c2", "c1")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df that are kept, with the columns they have: of every group, the document with the smallest id.

    Of rows alike in id and text one stays (a document that was taken in twice,
    copies without an id); other texts under one id are one document.
    """
    twice = stored(df.groupBy(F.col(id_col).alias("__twice")).count().filter("count > 1").select("__twice"), "ids-twice")
    if not twice.isEmpty():
        same = F.col(id_col).eqNullSafe(F.col("__twice"))
        # ids that occur once don't move
        df = df.join(twice, same, "left_anti").unionByName(df.join(twice, same, "left_semi").dropDuplicates([id_col, text_col]))
    gone = near_duplicates(df, id_col=id_col, text_col=text_col, **options).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(gone, F.col(id_col).cast("bigint") == F.col("__gone"), "left_anti")
