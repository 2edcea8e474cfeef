"""The catalog of item records: canonical JSON texts under their paths, kept as a snapshot table by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import category_folder, file_slug
from ..operators.quality import EFFECT, record_text, written_type
from .snapshots import Manifest, read_snapshot, upsert_snapshot

def _rank(update: Column) -> Column:
    return F.coalesce(F.regexp_extract(update, r"^update-(\d+)$", 1).try_cast("int"), F.lit((1 << 31) - 1))


def item_records(items: DataFrame, *more: str) -> DataFrame:
    """(id, update, category, slug, record, more…) of items in the form of extract_items() with their update; rows without an id have no record."""
    value = lambda e: F.when(e["value_is_float"], e["value"].cast("string")).otherwise(e["value"].cast("bigint").cast("string"))
    members = [x.split(":")[0] for x in EFFECT.removeprefix("struct<").split(",")]
    effects = F.transform("effects", lambda e: F.struct(*[(value(e) if m == "value" else e[m]).alias(m) for m in members]))
    stored = items.where("id is not null").withColumn("effects", effects)
    record = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in written_type()])
    return stored.select("id", F.coalesce("update", F.lit("unknown")).alias("update"), category_folder(F.col("category")).alias("category"), file_slug(F.col("name")).alias("slug"), record.alias("r"), *more).select("id", "update", "category", "slug", record_text("r").alias("record"), *more)


def _earliest(held: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes replace the records of their ids and keep the earlier update of both."""
    both = changes.join(held.select("id", F.col("update").alias("_old")), "id", "left")
    update = F.when(F.col("_old").isNotNull() & (_rank(F.col("_old")) <= _rank(F.col("update"))), F.col("_old")).otherwise(F.col("update"))
    return held.join(changes.select("id"), "id", "left_anti").unionByName(both.withColumn("update", update).drop("_old"))


def write_records(spark: SparkSession, root: str, records: DataFrame, *, buckets: int = 64, batch: tuple[str, int] | None = None) -> Manifest:
    """The next version of the catalog at root with item_records(), one of an id: each replaces the record of its id, wherever that lay, and
    keeps the earlier of both updates; unknown counts as the latest. Only the buckets of the given ids are rewritten."""
    return upsert_snapshot(spark, root, records, "id", _earliest, buckets=buckets, batch=batch)


def scan_records(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(path, record) of a catalog of write_records(): update/category/id-slug.json and the text of the file."""
    found = read_snapshot(spark, root, version)
    return found.select(F.concat(F.concat_ws("/", "update", "category", "id"), F.lit("-"), "slug", F.lit(".json")).alias("path"), "record")
