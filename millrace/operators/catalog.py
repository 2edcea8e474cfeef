"""Registry and keyed upserts of the catalog. Snapshots in, snapshots out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import page_key
from .ledger import first_by


def minted_id(page_id: Column, namespace: str = "catalog") -> Column:
    """A v4-shaped id that depends on the page alone, so a repeated task mints the same one; null without a page."""
    h = F.md5(F.concat(F.lit(namespace + "|"), page_id.cast("string")).cast("binary"))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.when(page_id.isNotNull(), F.concat_ws("-", *parts))


def registry_match(items: DataFrame, registry: DataFrame) -> DataFrame:
    """items with the id of their page, null where the registry has none; titles never decide."""
    return items.join(registry.select("page_id", "id"), "page_id", "left")


def registry_mint(items: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, page_id, title) of the pages that the registry lacks, the newest title of each."""
    new = items.where("page_id is not null").join(registry, "page_id", "left_anti")
    return new.groupBy("page_id").agg(F.max_by("title", F.struct("seq", "title")).alias("title")).select(minted_id(F.col("page_id")).alias("id"), "page_id", "title")


def registry_rename(items: DataFrame, registry: DataFrame) -> DataFrame:
    """The next registry: known pages keep their id and take the newest title, new ones are minted."""
    newest = items.where("page_id is not null").groupBy("page_id").agg(F.max_by("title", F.struct("seq", "title")).alias("_title"))
    joined = registry.join(newest, "page_id", "full_outer")
    return joined.select(F.coalesce("id", minted_id(F.col("page_id"))).alias("id"), "page_id", F.coalesce("_title", "title").alias("title"))


#: A lower-case version-4 id.
UUID4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def registry_defects(lines: DataFrame) -> DataFrame:
    """(line_no, problem) of lines(line_no, value) of a JSON Lines registry: the first problem of each line; blank lines pass."""
    keys = F.expr("json_object_keys(value)")
    parsed = lines.where("trim(value) <> ''").withColumns({"_keys": keys, "_id": F.get_json_object("value", "$.id"), "_title": F.get_json_object("value", "$.title")})
    number = F.regexp_extract("value", r'"page_id"\s*:\s*(-?\d+)\s*[,}]', 1)
    parsed = parsed.withColumn("_page", F.nullif(number, F.lit("")).try_cast("bigint"))
    # First lines by key come from partial aggregates over lines that have the key, and go back to them by plain joins.
    first = lambda c: parsed.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("line_no").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select(c, F.col("_first").alias(f"{c}_first"))
    for key in ("_page", "_id"):
        parsed = parsed.join(first(key), key, "left").withColumn(f"{key}_again", F.coalesce(F.col("line_no") > F.col(f"{key}_first"), F.lit(False)))
    problem = (
        F.when(F.col("_keys").isNull(), "not an object")
        .when(F.array_sort("_keys") != F.array(F.lit("id"), F.lit("page_id"), F.lit("title")), "wrong keys")
        .when(F.coalesce(~F.col("_id").rlike(UUID4), F.lit(True)), "bad id")
        .when(F.col("_page").isNull(), "bad page_id")
        .when(F.col("_page_again"), "page_id again")
        .when(F.col("_id_again"), "id again")
    )
    return parsed.select("line_no", problem.alias("problem")).where("problem is not null")


def split_null_page_id(items: DataFrame) -> DataFrame:
    """items with storable: false without a page id, which adds an error under wiki.page_id."""
    missing = F.col("page_id").isNull()
    error = F.when(missing, F.create_map(F.lit("wiki.page_id"), F.lit("missing"))).otherwise(F.create_map().cast("map<string,string>"))
    return items.withColumn("storable", ~missing).withColumn("errors", F.map_concat("errors", error))


def introduced_update(listed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(id, update, n): for each id the lowest numbered listing of both; unknown ranks last."""
    every = listed.select("id", "update") if existing is None else listed.select("id", "update").unionByName(existing.select("id", "update"))
    number = F.nullif(F.regexp_extract("update", r"^update-(\d+)$", 1), F.lit("")).try_cast("int")
    ranked = every.withColumn("n", number)
    best = F.min(F.struct(F.coalesce("n", F.lit(2147483647)).alias("rank"), "update", "n"))
    return ranked.groupBy("id").agg(best.alias("b")).select("id", "b.update", "b.n")


def one_row_per_id(rows: DataFrame) -> DataFrame:
    """The newest row(id, path, seq) of each id, and whether it moved from the one before."""
    w = Window.partitionBy("id").orderBy("seq", "path")
    ranked = rows.withColumn("_before", F.lag("path").over(w))
    return first_by(ranked, ["id"], F.desc("seq"), F.desc("path")).withColumn("moved", F.coalesce(F.col("_before") != F.col("path"), F.lit(False))).drop("_before")


def skip_reports(outcomes: DataFrame) -> DataFrame:
    """(page_id, outcome, has_item, has_report): a skipped page keeps its report and has no item."""
    return outcomes.select("page_id", "outcome", (F.col("outcome") == "extracted").alias("has_item"), F.col("outcome").isin("extracted", "skipped").alias("has_report"))


def tag_reports(reports: DataFrame, queue: DataFrame) -> DataFrame:
    """reports(url, …) with the listing of the queue row of the same page, whatever the spelling of the URL."""
    listed = queue.select(page_key(F.col("wiki_url")).alias("_key"), "update_page")
    return reports.withColumn("_key", page_key(F.col("url"))).join(listed, "_key", "left").drop("_key")


def revision_change(state: DataFrame, seen: DataFrame) -> DataFrame:
    """Listings whose revision in seen differs from a stored one that is not null."""
    joined = state.join(seen.withColumnRenamed("revision_id", "new_revision"), "page_name")
    return joined.where("revision_id is not null and not (revision_id <=> new_revision)").select("page_name", "revision_id", "new_revision")


def upsert_latest(rows: DataFrame, keys: list[str], *newest: str) -> DataFrame:
    """The last write of every key."""
    return first_by(rows, keys, *[F.desc(c) for c in newest])
