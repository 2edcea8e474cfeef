"""Tables as snapshots: rows in hash buckets of their key, and a manifest a version that says which folder holds each bucket.

An upsert reads and rewrites only the buckets that its changes fall into and then adds a manifest; nothing that an earlier manifest names is
touched. A reader takes one manifest and sees one snapshot. A write that fails leaves folders that no manifest names. A manifest is made
only if its version is not there yet, so of two writers one fails. Batches of a stream carry a number, and one that is in already is
not applied again. Folders lie below the table's root, in whatever store that is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workers import written

BUCKET = "_bucket"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Manifest:
    """One version of a table: its key, columns, the folder of each bucket that has rows, and the last batch of each stream."""

    key: str
    buckets: int
    columns: str
    version: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def _store(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _store(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The newest version of a table, or the one asked for; None where there is none. A manifest that is still being written is not there yet."""
    for name in reversed(_names(spark, f"{root}/_manifest")):
        if version is not None and name != f"{version:012d}.json":
            continue
        fs, path = _store(spark, f"{root}/_manifest/{name}")
        stream = fs.open(path)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Manifest(**json.loads(text))
        except json.JSONDecodeError:
            continue
    return None


def _publish(spark: SparkSession, root: str, now: Manifest) -> None:
    fs, path = _store(spark, f"{root}/_manifest/{now.version:012d}.json")
    stream = fs.create(path, False)  # fails if another writer made this version
    try:
        stream.write(bytearray(json.dumps(asdict(now)).encode()))
    finally:
        stream.close()


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that a stream keeps as long as its checkpoint: batch numbers begin anew in a new one."""
    fs, path = _store(spark, f"{checkpoint}/stream-name")
    if not fs.exists(path):
        stream = fs.create(path, False)
        stream.write(bytearray(uuid.uuid4().hex.encode()))
        stream.close()
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def newest(order: str, key: str) -> Merge:
    """Of held rows and changes the one with the largest order of each key, whichever came first."""

    def merge(held: DataFrame, changes: DataFrame) -> DataFrame:
        both = held.unionByName(changes)
        return both.groupBy(key).agg(F.max_by(F.struct(*both.columns), F.struct(order, *[c for c in both.columns if c not in (order, key)])).alias("_r")).select("_r.*")

    return merge


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, now: Manifest, only: list[int] | None = None) -> DataFrame:
    folders = [f for b, f in now.folders.items() if only is None or int(b) in only]
    columns = StructType.fromJson(json.loads(now.columns))
    return spark.read.schema(columns).parquet(*folders) if folders else spark.createDataFrame([], columns)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the newest version of a table, or of the one asked for, as long as vacuum() keeps it."""
    if (now := manifest(spark, root, version)) is None:
        raise FileNotFoundError(f"no snapshot of {root}" + ("" if version is None else f" has version {version}"))
    return _rows(spark, now)


def replacing(key: str) -> Merge:
    """Changes take the place of held rows of their key."""
    return lambda held, changes: held.join(changes.select(key), key, "left_anti").unionByName(changes)


def upsert_snapshot(spark: SparkSession, root: str, changes: DataFrame, key: str, merge: Merge | None = None, *, buckets: int = 64, batch: tuple[str, int] | None = None) -> Manifest:
    """The next version of the table at root, made by merge(held rows, changes) in the buckets of the changes' keys; other buckets stay.

    The first call makes the table, with so many buckets and the columns of merge's result. merge must keep rows in their key's bucket and
    give a key one row. Changes with a null key are an error of the caller. A batch (stream, number) that is in already changes nothing.
    """
    now = manifest(spark, root)
    if now is not None and batch and batch[1] <= now.batches.get(batch[0], -1):
        return now
    buckets = now.buckets if now else buckets
    changes = written(changes.withColumn(BUCKET, bucket_of(F.col(key), buckets)))
    touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
    changes = changes.drop(BUCKET)
    held = _rows(spark, now, touched) if now else changes.limit(0)
    merged = (merge or replacing(key))(held, changes)
    now = now or Manifest(key, buckets, merged.schema.json())
    folder, folders = f"{root}/data/{uuid.uuid4().hex}", {b: f for b, f in now.folders.items() if int(b) not in touched}
    if touched:
        placed = merged.withColumn(BUCKET, bucket_of(F.col(key), buckets)).repartition(len(touched), BUCKET)
        placed.write.option("compression", "zstd").partitionBy(BUCKET).parquet(folder)
        folders |= {x.split("=")[1]: f"{folder}/{x}" for x in _names(spark, folder) if x.startswith(f"{BUCKET}=")}
    now = replace(now, version=now.version + 1, folders=folders, batches=now.batches | ({batch[0]: batch[1]} if batch else {}))
    _publish(spark, root, now)
    return now


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the versions before the last `keep`, and the folders that no version left names, those of failed writes among them. Run it
    when no writer is at work. Gives the folders that went."""
    names = _names(spark, f"{root}/_manifest")
    kept = [manifest(spark, root, int(x.split(".")[0])) for x in names[-keep:]]
    named = {f for m in kept if m for f in m.folders.values()}
    gone = []
    for write in (f"{root}/data/{x}" for x in _names(spark, f"{root}/data")):
        own = [f"{write}/{x}" for x in _names(spark, write) if x.startswith(f"{BUCKET}=")]
        gone += [x for x in own if x not in named] if named & set(own) else [write]
    for path in [*gone, *[f"{root}/_manifest/{x}" for x in names[:-keep]]]:
        fs, at = _store(spark, path)
        fs.delete(at, True)
    return gone
