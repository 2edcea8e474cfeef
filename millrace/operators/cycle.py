"""One cycle from queue and held pages to items, ids, reports and the next queue, each page settled by its own outcome.

The parse writes one relation, in which every page has a row that says how it went; outcomes, items, reports and the queue are plans over
it. A page that can't be read fails alone, with the exception's text. commit() puts the results into four snapshot tables, the queue last:
a cycle that breaks before that leaves its rows pending, and running it again replaces what is there already.

Defined results. Pages meet queue rows by the key of their URL, whatever its spelling; of several pages of one key the last fetched counts,
ties by the larger html. A queue row without a page fails with "page not held". Null html has no content. A page without a page id is
complete and has a report with an error, but no item. Several queue rows of one page share its item, which takes the lowest update.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import page_key, update_slug
from ..sources.records import item_records, write_records
from ..sources.snapshots import Manifest, upsert_snapshot
from ..workers import written
from . import infobox as I
from .catalog import registry_rename
from .items import items_of, page_heads, picked_rows, read_pages
from .ledger import first_by, pending_items, reset_failed

# What a page is told when it fails or is skipped.
NOT_HELD, NO_CONTENT, NO_TABLE, NO_PAGE_ID = "page not held", "no mw-parser-output content", "no infobox table", "null page ID: no UUID, no item file written"
SKIP = "not an equippable named item: wiki category "


@dataclass(frozen=True)
class Cycle:
    """What one cycle gives; every part is written and can be read again and again."""

    outcomes: DataFrame  # (key, row, outcome, reason), one a page
    items: DataFrame  # items_of() with key and update
    reports: DataFrame  # (report, update, key, name, url, template, skipped, unmapped, errors), one a page and update
    registry: DataFrame  # (id, page_id, title), new and renamed pages
    queue: DataFrame  # rows whose status changed


def judged(parsed: DataFrame) -> DataFrame:
    """(row, page_key, url, outcome, reason) of read_pages(): extracted, skipped or failed, and why."""
    heads = page_heads(parsed).join(parsed.where("kind = 'cell'").select("page_id").distinct().withColumn("found", F.lit(True)), "page_id", "left")
    skipped = F.get(F.filter("categories", lambda c: c.rlike(I.SKIPPED)), F.lit(0))
    reason = (
        F.when(F.col("label") == "error", F.col("text"))
        .when(F.col("label") == "no_content", NO_CONTENT)
        .when(F.col("found").isNull(), F.coalesce(F.concat(F.lit(SKIP), skipped), F.lit(NO_TABLE)))
    )
    outcome = F.when(F.col("reason").isNull(), "extracted").when(F.startswith("reason", F.lit(SKIP)), "skipped").otherwise("failed")
    return heads.withColumn("reason", reason).select(F.col("page_id").alias("row"), "page_key", "url", outcome.alias("outcome"), "reason")


def _rank(update: Column) -> Column:
    return F.coalesce(F.regexp_extract(update, r"^update-(\d+)$", 1).try_cast("int"), F.lit((1 << 31) - 1))


def run_cycle(queue: DataFrame, pages: DataFrame, registry: DataFrame, now: Column, *, max_retries: int = 3, limit: int | None = None) -> Cycle:
    """queue as in the ledger, with wiki_url; pages(url, html, fetched_at); registry(id, page_id, title). Rows up to limit are processed."""
    ready = reset_failed(queue, max_retries)
    pending = written(pending_items(ready, limit).select("id", "update_page", "wiki_url", "retry_count", page_key(F.col("wiki_url")).alias("key"), update_slug(F.col("update_page")).alias("update")))
    held = pages.withColumn("key", page_key(F.col("url"))).join(pending.select("key").distinct(), "key", "left_semi")
    newest = held.groupBy("key").agg(F.max_by(F.struct("url", "html"), F.struct("fetched_at", F.length("html"), "html")).alias("p")).select("key", "p.*")
    parsed = read_pages(newest.withColumn("_key", F.lit(None).cast("long")), "_key", "html", "url")
    outcomes = written(judged(parsed).withColumn("key", page_key(F.col("url"))).drop("page_key", "url"))

    lowest = pending.groupBy("key").agg(F.min_by("update", F.struct(_rank(F.col("update")), "update")).alias("update"))
    keyed = items_of(parsed).withColumn("key", page_key(F.col("wiki.url"))).join(lowest, "key")
    titled = written(keyed)
    seen = titled.where("wiki.page_id is not null").select("wiki.page_id", F.coalesce("wiki.title", "key").alias("title"), F.col("key").alias("seq"))
    mine = registry.join(seen.select("page_id").distinct(), "page_id", "left_semi")
    ids = written(registry_rename(seen, mine).select("id", "page_id", "title"))
    known = ids.select(F.col("id").alias("known_id"), F.col("page_id").alias("known_page"))
    items = titled.join(known, F.col("wiki.page_id") == F.col("known_page"), "left").withColumn("id", F.col("known_id")).drop("known_id", "known_page")

    cells, _ = picked_rows(parsed)
    unmapped = I.unmapped(I.map_rows(cells)).groupBy(F.col("page_id").alias("row")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "text")))).alias("unmapped"))
    errors = F.when(F.col("wiki.page_id").isNull(), F.map_concat("extraction_errors", F.create_map(F.lit("wiki.page_id"), F.lit(NO_PAGE_ID)))).otherwise(F.col("extraction_errors"))
    told = items.select("row", "name", "template", errors.alias("errors"))
    done = outcomes.where("outcome <> 'failed'").join(told, "row", "left").join(unmapped, "row", "left").drop("row")
    shown = pending.select("key", "update", "wiki_url").groupBy("key", "update").agg(F.min("wiki_url").alias("url")).join(done, "key")
    title = F.regexp_replace(F.replace("key", F.lit("_"), F.lit(" ")), "^Item:", "")
    none = F.create_map().cast("map<string,string>")
    reports = shown.select(
        F.concat_ws("|", "update", "key").alias("report"), "update", "key", F.when(F.col("outcome") == "skipped", title).otherwise(F.col("name")).alias("name"), "url", "template",
        F.when(F.col("outcome") == "skipped", F.col("reason")).alias("skipped"), F.coalesce("unmapped", none).alias("unmapped"), F.coalesce("errors", none).alias("errors"),
    )

    result = pending.join(outcomes.select("key", "outcome", "reason"), "key", "left").select(
        "id", F.coalesce("outcome", F.lit("failed")).alias("outcome"), F.coalesce("reason", F.when(F.col("outcome").isNull(), NOT_HELD)).alias("reason"), F.col("outcome").isNotNull().alias("begun")
    )
    failed, began = F.col("outcome") == "failed", F.coalesce("begun", F.lit(False))
    settled = ready.join(result, "id", "left").join(queue.select("id", F.col("status").alias("_was")), "id").where("outcome is not null or status <> _was")
    settled = settled.withColumns(
        {
            "status": F.when(failed, "failed").when(F.col("outcome").isNotNull(), "complete").otherwise(F.col("status")),
            "started_at": F.when(began, now).otherwise(F.col("started_at")),
            "completed_at": F.when(F.col("outcome").isNotNull(), now).otherwise(F.col("completed_at")),
            "error_message": F.when(failed, F.col("reason")).otherwise(F.col("error_message")),
            "retry_count": (F.col("retry_count") + F.coalesce(failed, F.lit(False)).cast("int")).cast(queue.schema["retry_count"].dataType),
        }
    ).select(*queue.columns)
    return Cycle(outcomes, written(items), written(reports), ids, written(settled))


def commit(spark: SparkSession, root: str, done: Cycle, buckets: int = 64) -> dict[str, Manifest]:
    """Put a cycle into the tables registry, items, reports and queue below root; the queue comes last."""
    records = item_records(first_by(done.items.where("wiki.page_id is not null"), ["id"], "key"))
    return {
        "registry": upsert_snapshot(spark, f"{root}/registry", done.registry, "page_id", buckets=buckets),
        "items": write_records(spark, f"{root}/items", records, buckets=buckets),
        "reports": upsert_snapshot(spark, f"{root}/reports", done.reports, "report", buckets=buckets),
        "queue": upsert_snapshot(spark, f"{root}/queue", done.queue, "id", buckets=buckets),
    }
