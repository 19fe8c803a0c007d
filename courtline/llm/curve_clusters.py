"""Centroid clustering over space-filling-curve zone maps (operator 12).

*Layout.*  Vectors become whole numbers (``floor(scale * x)``) and are put in
the order of a Hilbert curve over their first principal axes; neighbours in
that order form blocks.  A block is one row of a stored table: its ids, its
packed vectors, and a zone map, the box of least and greatest coordinates along
all principal axes.  The axes come from a bounded sample; they are a rotation,
so they change which centroids can be ruled out, never a distance or a result.
Equal places on the curve are dealt out by id, so copies of one vector don't
meet in one task.

*Rounds.*  Over a box, the difference of the squared distances to two centroids
is linear, so its bound is exact at a corner.  Every centroid that is farther
than the one nearest the box's centre at all corners is ruled out for the whole
block; the vectors are compared with the rest in whole numbers.  Tasks return
sums and counts by centroid; the driver sees ``k`` rows of ``dims`` sums.

Results are exact whole numbers: they depend neither on blocks nor on tasks.

Defined cases: vectors that are null, of another length, with a null, NaN or
infinite component, or with one of ``2**27 / scale`` or more in size (squared
distances would not fit 64 bits) are left out; a null id is kept and orders
last among the first centroids; ids that occur twice are ordered by their
vectors; with fewer than ``k`` vectors there are fewer centroids, with none no
rows; equally near centroids: the smaller number; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from courtline.llm.store import stored, tune

#: Rows that may come to the driver for the principal axes.
SAMPLE = 4096
#: The curve: axes and bits an axis (together under 63 bits).
CURVE_AXES, CURVE_BITS = 8, 7
BLOCK_ROWS = 512
#: Components in whole numbers stay below this, so that 64 squared differences fit 62 bits.
LARGEST = 1 << 27


def whole_numbers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors to cluster, and floor(scale * x) of those."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(sizes == dims)
    flat = column.take(pa.array(right)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)      # a null comes as NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(scale * x)
        fine = (np.abs(x) < LARGEST).all(1)
    return right[fine], x[fine].astype(np.int32)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2**bits (rows: points, columns: axes).

    Skilling's transposition: undo the excess work of each bit from the top
    down, then Gray-code, then weave the bits together.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(axes):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        carry ^= np.where((x[axes - 1] & q) != 0, q - 1, 0)
    x ^= carry
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = place << 1 | (x[i] >> b & 1)
    return place


def principal_axes(sample: np.ndarray, dims: int) -> np.ndarray:
    """An orthonormal basis (columns), axes of greatest spread first."""
    if len(sample) < 2:
        return np.eye(dims)
    centred = sample - sample.mean(0)
    _, basis = np.linalg.eigh(centred.T @ centred)
    return np.ascontiguousarray(basis[:, ::-1])


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """[block, centroid]: whether any point of the block's box can be nearest to the centroid, by bounds of distance differences.

    ``lo``, ``hi``, ``centroids``: along the same axes.  The margin covers rounding of the rotated coordinates.
    """
    centre = (lo + hi) / 2
    norms = (centroids ** 2).sum(1)
    best = (norms - 2 * centre @ centroids.T).argmin(1)
    towards = centroids[best][:, None, :] - centroids[None, :, :]
    corner = np.where(towards > 0, lo[:, None, :], hi[:, None, :])
    least = norms[None, :] - norms[best][:, None] + 2 * (corner * towards).sum(2)
    margin = 1e-6 * (1 + norms.max() + np.maximum(lo ** 2, hi ** 2).sum(1))
    return least <= margin[:, None]


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the centroids ``among`` (ascending numbers) and the squared distance, in whole numbers."""
    c = centroids[among].astype(np.int64)
    x = x.astype(np.int64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 52:                       # every term is exact in a double
        x, c = x.astype(np.float64), c.astype(np.float64)
        d = ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    else:
        d = np.stack([((x - row) ** 2).sum(1) for row in c], 1)
    k = d.argmin(1)
    return among[k], d[np.arange(len(x)), k]


def _blocks(vectors: DataFrame, axes: np.ndarray, low: np.ndarray, high: np.ndarray, rows: int) -> DataFrame:
    """The stored layout: ids, packed vectors and zone map of each block."""
    dims = len(axes)
    width = np.where(high > low, high - low, 1.0)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _unpacked(b.column("v"), dims) @ axes[:, :len(low)]
                cells = np.clip((x - low) / width * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(hilbert(cells, CURVE_BITS))], ["vec_id", "v", "place"])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def done(part: pa.Table) -> pa.RecordBatch:
            x = _unpacked(part.column("v"), dims) @ axes
            ids = part.column("vec_id").combine_chunks()
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids)
            packed = b"".join(part.column("v").to_pylist())
            return pa.RecordBatch.from_arrays([ids, *(pa.array([v], pa.binary()) for v in (packed, x.min(0).tobytes(), x.max(0).tobytes()))], ["ids", "v", "lo", "hi"])

        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= rows:
                whole = pa.Table.from_batches(held)
                cut = count - count % rows
                for at in range(0, cut, rows):
                    yield done(whole.slice(at, rows))
                held, count = whole.slice(cut).to_batches(), count - cut
        if count:
            yield done(pa.Table.from_batches(held))

    at = vectors.mapInArrow(placed, "vec_id bigint, v binary, place bigint").withColumn("spread", F.xxhash64("vec_id", "v"))
    ordered = at.repartitionByRange("place", "spread").sortWithinPartitions("place", "spread", "vec_id", "v").select("vec_id", "v")
    return stored(ordered.mapInArrow(blocked, "ids array<bigint>, v binary, lo binary, hi binary"), "curve-blocks")


def _unpacked(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dims)


def _assigned(b: pa.RecordBatch, axes: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each block of a batch: ids, vectors, clusters, distances and the number of centroids compared."""
    dims = len(axes)
    lo, hi = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.float64).reshape(-1, dims) for c in ("lo", "hi"))
    may = candidates(lo, hi, centroids @ axes)
    ids = b.column("ids")
    for k, packed in enumerate(b.column("v").to_pylist()):
        x = np.frombuffer(packed, np.int32).reshape(-1, dims)
        among = np.flatnonzero(may[k])
        cluster, distance = nearest(x, centroids, among)
        yield ids[k].values, x, cluster, distance, len(among)


def _sums(blocks: DataFrame, axes: np.ndarray, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of every centroid's vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for _, x, cluster, _, _ in _assigned(b, axes, centroids):
                count += np.bincount(cluster, minlength=k)
                by = np.argsort(cluster, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], cluster[by][1:] != cluster[by][:-1]]))
                total[cluster[by][heads]] += np.add.reduceat(x[by].astype(np.int64), heads, axis=0)
        at = np.flatnonzero(count)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(at))), pa.array(np.repeat(count[at], dims)), pa.array(total[at].ravel())], ["cluster", "dim", "n", "total"])

    parts = blocks.mapInArrow(run, "cluster int, dim int, n bigint, total bigint")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("cluster", "dim").collect():  # k * dims rows
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def centroid_clusters(df: DataFrame, *, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, salt: str = "1", block_rows: int = BLOCK_ROWS,
                      id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 and compared (centroids that its block was compared with) of every vector.

    First centroids: the ``k`` vectors with the smallest lower-case hex sha256
    of ``salt:id``.  Each round assigns all vectors and moves every centroid
    that has some to the floor of their mean; a last assignment follows.
    """
    spark = tune(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = whole_numbers(b.column("vector"), dims, scale)
            if len(at):
                packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * 4 * dims), pa.py_buffer(np.ascontiguousarray(x))])
                yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)), packed], ["vec_id", "v"])

    vectors = rows.mapInArrow(whole, "vec_id bigint, v binary")
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.col("v")
    first = [r["v"] for r in vectors.orderBy(*order).limit(k).collect()]
    schema = "vec_id bigint, cluster int, distance bigint, compared int"
    if not first:
        kinds = ST.StructType.fromDDL("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, compared int")
        return spark.createDataFrame([], kinds)
    centroids = np.stack([np.frombuffer(v, np.int32) for v in first]).astype(np.int64)

    share = SAMPLE / max(SAMPLE, rows.count())
    picked = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))
    sample = np.stack([np.frombuffer(r["v"], np.int32) for r in vectors.filter(picked).select("v").limit(2 * SAMPLE).collect()] or [np.frombuffer(v, np.int32) for v in first]).astype(np.float64)
    axes = principal_axes(sample, dims)
    along = sample @ axes[:, :CURVE_AXES]
    blocks = _blocks(vectors, axes, along.min(0), along.max(0), block_rows)

    for _ in range(rounds):
        for c, (n, total) in _sums(blocks, axes, centroids).items():
            centroids[c] = [t // n for t in total]

    final = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, _, cluster, distance, compared in _assigned(b, axes, final):
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(np.full(len(cluster), compared, np.int32))], ["vec_id", "cluster", "distance", "compared"])

    found = stored(blocks.mapInArrow(assign, schema), "clusters")
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}  # k rows
    digest = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(final.tolist())}
    about = spark.createDataFrame([(c, inertia[c], digest[c]) for c in sorted(inertia)], "cluster int, cluster_inertia decimal(38,0), centroid_sha256 string")
    total = F.lit(sum(inertia.values())).cast("decimal(38,0)").cast("bigint")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", F.col("cluster_inertia").cast("bigint").alias("cluster_inertia"), total.alias("inertia"), "centroid_sha256", "compared")  # k rows at most
