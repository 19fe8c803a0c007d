"""A stored table that is upserted by key (S5), bucket by bucket.

Rows are dealt out by a hash of their key into a fixed number of buckets.  A
batch reads and writes only the buckets that its keys fall in; a commit
manifest says in which version's folder each bucket lies::

    <base>/version=<v>/bucket=<b>/*.parquet     rows of the buckets that version v wrote
    <base>/_manifest/<v>.json                   {"keys", "buckets", "schema", "at": {bucket: version}}

A version exists once its manifest does; that file is written whole under
another name and then renamed, and an existing one is never replaced.  So a
batch that failed half-way leaves no trace for readers and is written anew when
it is replayed, a batch that was committed before changes nothing, and of two
writers of one version the second fails.  Readers of a version are not
disturbed by later ones; ``vacuum`` removes folders that no kept manifest names.

The driver holds one number a bucket.  Work and bytes of an upsert grow with
the touched buckets (their number is the parameter to choose: a bucket of a
hundred MB or so), not with the table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtline.operators.upsert import last_wins, upsert

BUCKETS = 64
_BUCKET = "__bucket"


@dataclass(frozen=True)
class Manifest:
    version: int
    keys: tuple[str, ...]
    buckets: int
    schema: StructType
    at: dict[int, int]          # the version that wrote each bucket that holds rows


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, path = _fs(spark, f"{base}/_manifest")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def manifest(spark: SparkSession, base: str, version: int) -> Manifest:
    fs, path = _fs(spark, f"{base}/_manifest/{version}.json")
    stream = fs.open(path)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(version, tuple(said["keys"]), said["buckets"], StructType.fromJson(said["schema"]), {int(b): v for b, v in said["at"].items()})


def latest(spark: SparkSession, base: str, below: int | None = None) -> Manifest | None:
    """The newest committed version (below a given one), or None."""
    found = [v for v in versions(spark, base) if below is None or v < below]
    return manifest(spark, base, found[-1]) if found else None


def _commit(spark: SparkSession, base: str, m: Manifest) -> None:
    fs, path = _fs(spark, f"{base}/_manifest/{m.version}.json")
    _, part = _fs(spark, f"{base}/_manifest/_{m.version}.part")
    out = fs.create(part, True)
    try:
        out.write(json.dumps({"keys": m.keys, "buckets": m.buckets, "schema": m.schema.jsonValue(), "at": m.at}).encode())
    finally:
        out.close()
    if fs.exists(path) or not fs.rename(part, path):
        raise RuntimeError(f"version {m.version} of {base} was committed by another writer")


def _read(spark: SparkSession, base: str, m: Manifest, buckets: Sequence[int]) -> DataFrame:
    paths = [f"{base}/version={m.at[b]}/bucket={b}" for b in buckets if b in m.at]
    return spark.read.schema(m.schema).parquet(*paths) if paths else spark.createDataFrame([], m.schema)


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version (default: the newest), or None if there is none."""
    m = latest(spark, base) if version is None else manifest(spark, base, version)
    return None if m is None else _read(spark, base, m, sorted(m.at))


def bucket_of(schema: StructType, keys: Sequence[str], buckets: int) -> Column:
    """A row's bucket, by its key in the table's own types."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")


def read_keys(spark: SparkSession, base: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in ``wanted``; only the buckets of those keys are read."""
    m = latest(spark, base)
    if m is None:
        raise ValueError(f"no table at {base}")
    asked = wanted.select(*[F.col(k).cast(m.schema[k].dataType).alias(k) for k in m.keys]).distinct()
    touched = _touched(asked, m.schema, m.keys, m.buckets)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(m.keys)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return _read(spark, base, m, touched).join(asked.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(m.keys)]), on, "left_semi")


def _touched(rows: DataFrame, schema: StructType, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets that rows fall in: ``buckets`` numbers at most."""
    return sorted(r[0] for r in rows.select(bucket_of(schema, keys, buckets)).distinct().collect())


def upsert_stored(spark: SparkSession, base: str, batch: DataFrame, version: int, keys: Sequence[str], seq: str,
                  ingested_at: Column, buckets: int = BUCKETS) -> Manifest:
    """Insert or overwrite the batch's keys as version ``version`` and return its manifest.

    Within the batch the row with the greatest ``seq`` wins; ``ingested_at`` is
    set if the table has that column (a new table always does).  ``keys``,
    columns and bucket count of an existing table stay as they are.  A committed
    version is left alone, whatever the batch holds.
    """
    if version in versions(spark, base):
        return manifest(spark, base, version)
    before = latest(spark, base, below=version)
    if before is None:
        new = last_wins(batch.withColumn("ingested_at", ingested_at.cast("timestamp")), keys, [seq])
        m = Manifest(version, tuple(keys), buckets, StructType.fromJson(new.schema.jsonValue()), {})
    else:
        if tuple(keys) != before.keys:
            raise ValueError(f"the table's keys are {before.keys}")
        m = before
        typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in m.schema.fields if f.name != "ingested_at"],
                             *[F.lit(None).cast(f.dataType).alias(f.name) for f in m.schema.fields if f.name == "ingested_at"])
        old = _read(spark, base, m, _touched(typed, m.schema, keys, m.buckets))
        new = upsert(old, typed, keys, seq, ingested_at)
    rows = new.withColumn(_BUCKET, bucket_of(m.schema, m.keys, m.buckets))
    # a bucket's rows come from several tasks, by key, so that none holds a bucket that has grown large
    folder = f"{base}/version={version}"
    dealt = rows.repartition(_BUCKET, F.pmod(F.xxhash64(*[F.col(k) for k in m.keys], F.lit("spread")), F.lit(4)))
    dealt.withColumn("bucket", F.col(_BUCKET)).drop(_BUCKET).write.mode("overwrite").partitionBy("bucket").parquet(folder)
    done = Manifest(version, m.keys, m.buckets, m.schema, {**(before.at if before else {}), **dict.fromkeys(_written(spark, folder), version)})
    _commit(spark, base, done)
    return done


def _written(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _fs(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return [int(n.partition("=")[2]) for n in names if n.startswith("bucket=")]


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove the manifests of all but the newest ``keep`` versions and the folders only they name; returns the folders.

    Uncommitted folders above the newest version may belong to a running batch and stay.
    """
    found = versions(spark, base)
    kept, old = found[-keep:], found[:-keep]
    used = {(v, b) for k in kept for b, v in manifest(spark, base, k).at.items()}
    for v in old:                                       # no reader may start from what loses its folders
        fs, path = _fs(spark, f"{base}/_manifest/{v}.json")
        fs.delete(path, False)
    gone = []
    fs, root = _fs(spark, base)
    for f in fs.listStatus(root) if found else ():
        name = f.getPath().getName()
        if not name.startswith("version=") or int(name.partition("=")[2]) > found[-1]:
            continue
        v = int(name.partition("=")[2])
        for b in _written(spark, f"{base}/{name}"):
            if (v, b) not in used:
                fs.delete(_fs(spark, f"{base}/{name}/bucket={b}")[1], True)
                gone.append(f"{name}/bucket={b}")
        if not any(x == v for x, _ in used):
            fs.delete(f.getPath(), True)
    return sorted(gone)
