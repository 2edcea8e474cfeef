"""Readers and writers: pages, indexes, registries, item files, reports, bundles and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.analysis import log_message
from ..operators.bundle import bundle_rows
from ..operators.catalog import upsert_latest


def scan_pages(pages: DataFrame) -> DataFrame:
    """All held pages by title. Sorting is for the edge; operators take the rows unsorted."""
    return pages.orderBy("title")


def missing_files(index: DataFrame, files: DataFrame) -> DataFrame:
    """Index rows whose file is gone."""
    return index.join(files, "file", "left_anti")


def page_lookup(pages: DataFrame, title: str) -> DataFrame:
    return pages.where(F.col("title") == title)


def page_lookup_name(pages: DataFrame, name: str) -> DataFrame:
    """The first page by title whose title without Item: equals the name, in any case."""
    wanted = name.strip().lower()
    return pages.where(F.lower(F.trim(F.regexp_replace("title", "^Item:", ""))) == wanted).orderBy("title").limit(1)


def held_unheld(requested: DataFrame, pages: DataFrame, key: str = "title") -> DataFrame:
    """requested with held: whether a page of that key is there."""
    known = pages.select(key).distinct().withColumn("_held", F.lit(True))
    return requested.join(known, key, "left").withColumn("held", F.col("_held").isNotNull()).drop("_held")


def upsert_pages(held: DataFrame, fetched: DataFrame) -> DataFrame:
    """The next snapshot of pages(title, fetched_at, seq, …): the last write of each title."""
    return upsert_latest(held.unionByName(fetched), ["title"], "fetched_at", "seq")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, line) of text files, lines numbered from 0 in each. Large files are read in splits: a split's lines are counted, and what earlier
    splits of the file hold is a sum over one row a split. An end of file after a line break is no line of its own."""
    row = F.monotonically_increasing_id().alias("_row")  # ascends within a task, and so within a split
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), row, F.col("value").alias("line"))
    splits = lines.groupBy("path", "_start").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    return lines.join(offsets, ["path", "_start"]).select("path", (F.col("_row") + F.col("_offset")).alias("pos"), "line")


def scan_seed(spark: SparkSession, path: str) -> DataFrame:
    """(pos, page): one listing title per line; list marks, comments and blank lines go."""
    page = F.trim(F.regexp_replace(F.regexp_replace("line", "#.*$", ""), r"^\s*-\s*", ""))
    return text_lines(spark, path).select("pos", page.alias("page")).where("page <> ''")


def scan_log(lines: DataFrame) -> DataFrame:
    """lines(run, seq, line) as (run, seq, message)."""
    return lines.select("run", "seq", log_message(F.col("line")).alias("message"))


def write_registry(registry: DataFrame, path: str) -> None:
    """One JSON object a line, by page id across files and within them; the same rows give the same bytes."""
    registry.select("id", "page_id", "title").repartitionByRange("page_id").sortWithinPartitions("page_id").write.mode("errorifexists").json(path)


def write_items(held: DataFrame | None, items: DataFrame, path: str) -> None:
    """The next snapshot below update/category: an item replaces the one of its id, which keeps the earlier of both updates, wherever
    it lay; all others stay as they are."""
    if held is not None:
        rank = lambda c: F.coalesce(F.regexp_extract(c, r"^update-(\d+)$", 1).try_cast("int"), F.lit((1 << 31) - 1))
        old = held.select("id", F.col("update").alias("_old"))
        moved = items.join(old, "id", "left").withColumn("update", F.when(F.col("_old").isNotNull() & (rank(F.col("_old")) < rank(F.col("update"))), F.col("_old")).otherwise(F.col("update"))).drop("_old")
        items = held.join(items, "id", "left_anti").unionByName(moved)
    items.write.partitionBy("update", "category").parquet(path)


def scan_items(spark: SparkSession, path: str) -> DataFrame:
    """(path, record): every item file below a folder as text, with its path inside it."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return whole.select(F.substring_index(F.col("_metadata.file_path"), path.rstrip("/").split("/")[-1] + "/", -1).alias("path"), F.col("value").alias("record"))


def write_reports(old: DataFrame, new: DataFrame) -> DataFrame:
    """The next report table(update, page_key, seq, line): one line per update and page, the newest."""
    return upsert_latest(old.unionByName(new), ["update", "page_key"], "seq")


def scan_bundle(spark: SparkSession, folder: str, schemas: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables of a bundle that are there, typed by their schemas, and (name) of those that are missing; see bundle_rows() for the files."""
    rows, missing = bundle_rows(spark, folder)
    missing = missing.where(F.col("name").isin(*schemas))
    lost = {x.name for x in missing.collect()}  # at most one row a table of the bundle
    typed = lambda name, kind: rows.where(F.col("table_name") == name).select(F.from_json(F.to_json("v"), kind).alias("r")).select("r.*")
    return {n: typed(n, kind) for n, kind in schemas.items() if n not in lost}, missing
