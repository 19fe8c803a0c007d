"""Near duplicates among embeddings by product quantisation (operator 1).

Vectors are compared only under an equal label (not null) and length.  Equal
vectors are one class from the start.  On a bounded sample, k-means makes the
coarse centroids, and one codebook per subspace for the residuals.  Every
class goes to the inverted list of its nearest centroid with its residual
codes and the length of what the codes leave out.

Probes are sufficient, not guessed: a vector can only be within reach r (the
distance that the cosine threshold means for unit vectors) of a member of
another list if it is within r of the plane that halves the way between both
centroids.  Of the two lists of a pair only the later one is probed.  A list's
members pass if the asymmetric table-lookup distance is at most r plus what
their codes leave out, which by the triangle inequality loses nothing; the
cosine of those that pass is computed exactly, in double precision.

A long list (under one label) is split in blocks, and so are its queries; a
task sees one block of each.  It gives back, for each vector, how many it
links there and a root that all it reaches there share, never the pairs.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component, and those without a label, link with nothing; a row without an id
has no component and is kept; repeated rows are vectors of their own; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.components import components
from courtline.llm.store import stored, tune

#: Rows the quantiser is fitted on, at most; every row is indexed.
TRAIN_ROWS = 40_000
LISTS = 1024
#: Lists are as many as leave the largest label group about this many rows each: a query goes to every list it probes,
#: so more lists than that would cost more copies of queries than they save comparisons.
PER_LIST = 2048
SUBSPACES = 8
CODES = 256
BLOCK = 2048
SLACK = 1e-6


def unit_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of unit length padded with zeros to ``width``, each row's length, which rows are vectors)."""
    n = len(column)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), lengths)
    at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((n, max(width, int(lengths.max(initial=1)))))
    out[row, at] = flat
    ok = np.isfinite(out).all(1) & (lengths > 0)
    out[~ok] = 0
    out += 0.0                                                   # -0.0 is 0.0
    out /= np.maximum(np.abs(out).max(1), 1e-300)[:, None]
    norm = np.sqrt((out * out).sum(1))
    ok &= norm > 0
    return out / np.where(norm > 0, norm, 1)[:, None], lengths, ok


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """k centroids (empty ones are dealt a random row)."""
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([_squares(x[i:i + 8192], centre).argmin(1) for i in range(0, len(x), 8192)])
        count = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.integers(0, len(x), len(centre))])
    return centre


@dataclass
class Quantiser:
    centroids: np.ndarray         # lists x width
    books: np.ndarray             # subspaces x codes x part
    width: int

    def parts(self, x: np.ndarray) -> np.ndarray:
        """rows x subspaces x part (the last subspace padded with zeros)."""
        m, _, part = self.books.shape
        padded = np.zeros((len(x), m * part))
        padded[:, :x.shape[1]] = x
        return padded.reshape(len(x), m, part)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, what the codes leave out, and squared distances to all centroids."""
        d = _squares(x, self.centroids)
        near = d.argmin(1)
        rest = self.parts(x - self.centroids[near])
        codes = np.stack([_squares(rest[:, m], self.books[m]).argmin(1) for m in range(len(self.books))], 1)
        left = rest - self.books[np.arange(len(self.books)), codes]
        return near, codes.astype(np.uint8), np.sqrt((left * left).sum((1, 2))), d

    def probes(self, near: np.ndarray, d: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, lists after their own) that may hold something within reach."""
        apart = np.sqrt(_squares(self.centroids, self.centroids))
        own = np.take_along_axis(d, near[:, None], 1)
        to_plane = (d - own) / np.maximum(2 * apart[near], 1e-12)
        return np.nonzero((to_plane <= reach + SLACK) & (np.arange(len(self.centroids))[None] > near[:, None]))


def fit(vectors: np.ndarray, lists: int, seed: int = 11) -> Quantiser:
    """From unit vectors (at least one)."""
    rng = np.random.default_rng(seed)
    width = vectors.shape[1]
    centroids = k_means(vectors, max(1, min(lists, len(vectors) // 8 or 1)), rng)
    rest = vectors - centroids[_squares(vectors, centroids).argmin(1)] if len(vectors) <= 8192 else np.concatenate([vectors[i:i + 8192] - centroids[_squares(vectors[i:i + 8192], centroids).argmin(1)] for i in range(0, len(vectors), 8192)])
    part = -(-width // min(SUBSPACES, width))
    m = -(-width // part)
    out = Quantiser(centroids, np.zeros((m, 1, part)), width)
    rest = out.parts(rest)
    k = min(CODES, len(vectors))
    out.books = np.stack([k_means(rest[:, s], k, rng, 6) for s in range(m)])
    return out


def link_block(q: Quantiser, at: int, queries: np.ndarray, members: np.ndarray, codes: np.ndarray, left: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) pairs of list ``at`` with a cosine of the threshold or more."""
    reach = math.sqrt(2 - 2 * threshold)
    found_q, found_m = [], []
    for i in range(0, len(queries), 256):
        x = queries[i:i + 256]
        rest = q.parts(x - q.centroids[at])
        distance = np.zeros((len(x), len(members)))
        for m in range(len(q.books)):
            distance += _squares(rest[:, m], q.books[m])[:, codes[:, m]]      # a look-up in the query's table
        a, b = np.nonzero(np.sqrt(distance) <= reach + left[None] + SLACK)
        for k in range(0, len(a), 1 << 16):
            s, t = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
            near = np.einsum("ij,ij->i", x[s], members[t]) >= threshold
            found_q.append(s[near] + i)
            found_m.append(t[near])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_q or empty), np.concatenate(found_m or empty)


def _indexed(classes: DataFrame, q: Quantiser, threshold: float) -> DataFrame:
    """Every class with its list, codes, and the lists that it probes (its own among them)."""
    reach = math.sqrt(2 - 2 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _, _ = unit_vectors(b.column("v"), q.width)
            for i in range(0, len(x), 1024):
                part = x[i:i + 1024]
                near, codes, left, d = q.encode(part)
                rows, lists = q.probes(near, d, reach)
                rows, lists = np.concatenate([np.arange(len(part)), rows]), np.concatenate([near, lists])
                by = np.lexsort((lists, rows))
                ends = np.searchsorted(rows[by], np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays([
                    *(b.column(c).slice(i, len(part)) for c in ("rep", "grp", "mult")), pa.array(near.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(lists[by].astype(np.int32))),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left), b.column("v").slice(i, len(part))], ["rep", "grp", "mult", "list", "probed", "codes", "left", "v"])

    return classes.mapInArrow(run, "rep bigint, grp bigint, mult bigint, list int, probed array<int>, codes binary, left double, v array<double>")


def _linked(units: DataFrame, q: Quantiser, threshold: float) -> DataFrame:
    """node, links (to how many vectors), root: what each vector links within a unit."""

    def unit(t: pa.Table) -> pa.RecordBatch | None:
        member = t["member"].to_numpy()
        rep, mult, own = (t[c].to_numpy() for c in ("rep", "mult", "own"))
        at = int(t["list"][0].as_py())
        x, _, _ = unit_vectors(t["v"].combine_chunks() if isinstance(t["v"], pa.ChunkedArray) else t["v"], q.width)
        mine, asks = np.flatnonzero(member), np.flatnonzero(~member)
        if not len(mine) or not len(asks):
            return None
        codes = np.frombuffer(b"".join(t["codes"].take(pa.array(mine)).to_pylist()), np.uint8).reshape(len(mine), -1)
        a, b = link_block(q, at, x[asks], x[mine], codes, t["left"].to_numpy()[mine], threshold)
        a, b = asks[a], mine[b]
        ok = (own[a] != at) | (rep[a] < rep[b])                   # within a list a pair meets twice
        a, b = a[ok], b[ok]
        if not len(a):
            return None
        links = np.bincount(a, weights=mult[b], minlength=len(rep)) + np.bincount(b, weights=mult[a], minlength=len(rep))
        root = rep.copy()
        while True:                                               # the least id that each reaches here
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            if (new == root).all():
                break
            root = new
        # a vector may be here twice, as a member and as a query: (rep, root) of both rows joins them
        hit = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(links[hit].astype(np.int64)), pa.array(root[hit])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            names = b.column("unit").to_numpy()
            heads = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for s, e in zip(heads[:-1], heads[1:], strict=True):
                if e == s:
                    continue
                if held and held[-1].column("unit")[0].as_py() != names[s]:
                    got = unit(pa.Table.from_batches(held).combine_chunks())
                    held = []
                    if got is not None:
                        yield got
                held.append(b.slice(s, e - s))
        if held:
            got = unit(pa.Table.from_batches(held).combine_chunks())
            if got is not None:
                yield got

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "node bigint, links bigint, root bigint")


def embedding_duplicates(df: DataFrame, *, threshold: float = 0.93, train_rows: int = TRAIN_ROWS, lists: int = LISTS, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept (vec_id = component_id) of every row."""
    tune(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, lengths, ok = unit_vectors(b.column("v"), 1)
            label = b.column("label").to_pylist()
            ok &= np.array([v is not None for v in label], bool)
            keys = [xxhash.xxh3_128_digest(a.tobytes() + str(n).encode() + b"|" + (s or "").encode()) for a, n, s in zip(_raw(b.column("v"), ok), lengths.tolist(), label, strict=True)]
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            grp = np.array([xxhash.xxh3_64_intdigest(f"{n}|{s}") for n, s in zip(lengths.tolist(), label, strict=True)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(ok), pa.array(lengths), pa.array(grp), pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1]))], ["vec_id", "v", "ok", "width", "grp", "k1", "k2"])

    named = stored(rows.mapInArrow(name, "vec_id bigint, v array<double>, ok boolean, width bigint, grp bigint, k1 bigint, k2 bigint").withColumn("ok", F.col("ok") & F.col("vec_id").isNotNull()), "vectors")
    reps = named.filter("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
    reps = stored(reps, "classes")
    classes = named.filter("ok").join(reps, ["k1", "k2"]).filter("vec_id = rep").dropDuplicates(["k1", "k2"]).select("rep", "grp", "mult", "width", "v")
    classes = stored(classes, "classes")
    n, width = classes.groupBy("grp").agg(F.count("*").alias("n"), F.max("width").alias("w")).agg(F.max("n"), F.max("w")).first()
    if not n:
        return named.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(train_rows).select("v").toArrow()["v"].combine_chunks()
    x, _, _ = unit_vectors(sample, width)
    model = fit(x, min(lists, -(-n // PER_LIST)))

    index = stored(_indexed(classes, model, threshold), "index")
    asks = index.select("rep", "grp", "mult", F.col("list").alias("own"), "v", F.explode("probed").alias("list"))
    members = index.select("rep", "grp", "mult", F.col("list").alias("own"), "v", "list", "codes", "left")
    # blocks of a (group, list): as many as its members, and its queries, need
    m = members.groupBy("grp", "list").agg(F.ceil(F.count("*") / block).alias("m_blocks"))
    a = asks.groupBy("grp", "list").agg(F.ceil(F.count("*") / block).alias("a_blocks"))
    blocks = stored(m.join(a, ["grp", "list"]), "blocks")

    def placed(side: DataFrame, own: str, other: str, member: bool) -> DataFrame:
        here = F.pmod(F.xxhash64("rep"), F.col(own))
        there = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias("there")
        out = side.join(blocks, ["grp", "list"]).withColumn("here", here).select("*", there)
        x, y = ("here", "there") if member else ("there", "here")
        empty = {} if member else {"codes": F.lit(None).cast("binary"), "left": F.lit(None).cast("double")}
        out = out.withColumns(empty) if empty else out
        return out.select(F.xxhash64("grp", "list", x, y).alias("unit"), F.lit(member).alias("member"), "list", "rep", "mult", "own", "codes", "left", "v")

    units = placed(members, "m_blocks", "a_blocks", True).unionByName(placed(asks, "a_blocks", "m_blocks", False))
    found = stored(_linked(units, model, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())

    out = named.join(reps, ["k1", "k2"], "left").withColumn("rep", F.when(F.col("ok"), F.col("rep")))
    out = out.join(links.withColumnRenamed("node", "rep"), "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("ok"), F.coalesce("component", "rep")).otherwise(F.col("vec_id"))
    n_links = F.when(F.col("ok"), F.coalesce("links", F.lit(0)) + F.col("mult") - 1).otherwise(0).cast("bigint")
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _raw(column: pa.Array, ok: np.ndarray) -> list[np.ndarray]:
    """Each row's components as given (-0.0 as 0.0); rows that are no vectors count as empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False) + 0.0
    ends = np.cumsum(lengths)
    return [flat[e - n:e] if good else flat[:0] for e, n, good in zip(ends.tolist(), lengths.tolist(), ok.tolist(), strict=True)]
