"""The work ledger: listings and queue rows as snapshots. Every operator reads one snapshot and returns the next.

queue(id, item_name, update_page, status, queued_at, started_at, completed_at, error_message, retry_count);
listing_state(page_name, page_url, last_synced_at, revision_id). Orders by listing put numbers first, in numeric
order, then the names without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import update_number

STATUSES = ("pending", "in_progress", "complete", "failed", "skipped")


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of every key in an order; unlike dropDuplicates this is the same row on every run."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def register_listings(state: DataFrame, listings: DataFrame) -> DataFrame:
    """state with the listings(page_name, page_url) that it does not know yet."""
    new = first_by(listings, ["page_name"], "page_url").join(state, "page_name", "left_anti")
    return state.unionByName(new, allowMissingColumns=True)


def mark_synced(state: DataFrame, synced: DataFrame) -> DataFrame:
    """state with the newest time and revision of synced(page_name, synced_at, revision_id)."""
    newest = synced.groupBy("page_name").agg(F.max(F.struct("synced_at", "revision_id")).alias("_s"))
    joined = state.join(newest, "page_name", "left")
    return joined.withColumn("last_synced_at", F.coalesce("_s.synced_at", "last_synced_at")).withColumn("revision_id", F.when(F.col("_s").isNotNull(), F.col("_s.revision_id")).otherwise(F.col("revision_id"))).drop("_s")


def listing_status(state: DataFrame, page_name: str) -> DataFrame:
    return state.where(F.col("page_name") == page_name)


def with_number(df: DataFrame, listing: str) -> DataFrame:
    return df.withColumn("n", update_number(F.col(listing)))


def list_listings(state: DataFrame) -> DataFrame:
    return with_number(state, "page_name").orderBy(F.asc_nulls_last("n"), "page_name")


def list_or_seed(found: DataFrame, seed: DataFrame) -> DataFrame:
    """The listings found, or the seed(page_name) where none was found. Reading the result fails if both are empty: nothing could be synced."""
    none = ~found.exists()
    lost = none & ~seed.exists()
    error = found.sparkSession.range(1).where(lost).select(F.raise_error(F.lit("neither the index nor the seed lists a page")).cast("string").alias("page_name"))
    return found.select("page_name").unionByName(seed.select("page_name").where(none)).unionByName(error)


def enqueue(queue: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of links(item_name, update_page, wiki_url, pos) that are new to the queue, each pair once, the first by pos; of equal pos, the first
    as links are read."""
    keys = ["item_name", "update_page"]
    read = links.withColumn("_read", F.monotonically_increasing_id())
    return first_by(read, keys, "pos", "_read").drop("_read").join(queue, keys, "left_anti").withColumn("status", F.lit("pending")).withColumn("retry_count", F.lit(0))


def pending_items(queue: DataFrame, limit: int | None = None) -> DataFrame:
    found = with_number(queue.where("status = 'pending'"), "update_page").orderBy(F.asc_nulls_last("n"), "update_page", "id")
    return found if limit is None else found.limit(limit)


def queue_stats(queue: DataFrame) -> DataFrame:
    """One row: rows of every status, zero without any, and in all."""
    return queue.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.count("*").alias("total"))


def listing_items(queue: DataFrame, page_name: str) -> DataFrame:
    return queue.where(F.col("update_page") == page_name).orderBy("queued_at", "id")


def apply_status(queue: DataFrame, events: DataFrame) -> DataFrame:
    """queue after the latest event(id, seq, status, started_at, completed_at) of each row; null times leave the old ones."""
    latest = events.groupBy("id").agg(F.max_by("status", "seq").alias("_status"), *[F.max_by(t, F.when(F.col(t).isNotNull(), F.col("seq"))).alias(f"_{t}") for t in ("started_at", "completed_at")])
    joined = queue.join(latest, "id", "left")
    for c in ("status", "started_at", "completed_at"):
        joined = joined.withColumn(c, F.coalesce(f"_{c}", c))
    return joined.drop("_status", "_started_at", "_completed_at")


def apply_failures(queue: DataFrame, failures: DataFrame) -> DataFrame:
    """queue after failures(id, seq, completed_at, message): failed, the last message, a retry more for each."""
    summed = failures.groupBy("id").agg(F.count("*").alias("_n"), F.max(F.struct("seq", "completed_at", "message")).alias("_f"))
    joined = queue.join(summed, "id", "left")
    hit = F.col("_n").isNotNull()
    return (
        joined.withColumn("status", F.when(hit, "failed").otherwise(F.col("status")))
        .withColumn("completed_at", F.when(hit, F.col("_f.completed_at")).otherwise(F.col("completed_at")))
        .withColumn("error_message", F.when(hit, F.col("_f.message")).otherwise(F.col("error_message")))
        .withColumn("retry_count", (F.col("retry_count") + F.coalesce("_n", F.lit(0))).cast("bigint"))
        .drop("_n", "_f")
    )


def reset_failed(queue: DataFrame, max_retries: int) -> DataFrame:
    """Failed rows below the retry cap become pending without times; the others stay."""
    again = (F.col("status") == "failed") & (F.col("retry_count") < max_retries)
    out = queue.withColumn("_again", F.coalesce(again, F.lit(False)))
    for c in ("started_at", "completed_at"):
        out = out.withColumn(c, F.when(~F.col("_again"), F.col(c)))
    return out.withColumn("status", F.when(F.col("_again"), "pending").otherwise(F.col("status"))).drop("_again")


def listing_cascade(queue: DataFrame, state: DataFrame) -> DataFrame:
    """Queue rows whose listing still exists."""
    return queue.join(state, queue["update_page"] == state["page_name"], "left_semi")


def queue_view(queue: DataFrame) -> DataFrame:
    """Per listing: its number, and its pending rows."""
    return with_number(queue.groupBy("update_page").agg(F.count_if(F.col("status") == "pending").alias("pending")), "update_page")


def next_batch(queue: DataFrame, seed: DataFrame, limit: int) -> DataFrame:
    """(page, n): listings with pending rows, and, if these are fewer than limit, the lowest seed(page) never queued."""
    view = queue_view(queue)
    waiting = view.where("pending > 0").select(F.col("update_page").alias("page"), "n")
    total = view.agg(F.coalesce(F.sum("pending"), F.lit(0)).alias("_total"))
    unread = with_number(seed.join(view, seed["page"] == view["update_page"], "left_anti"), "page").orderBy(F.asc_nulls_last("n"), "page").limit(1)
    more = unread.join(total, F.col("_total") < limit).select("page", "n")  # one row each
    return waiting.union(more)


def sync_status(queue: DataFrame, state: DataFrame, seed: DataFrame) -> DataFrame:
    """Per known or seeded listing: its state, counts of its rows by status, and whether it was ever read."""
    counts = queue.groupBy("update_page").agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    named = state.select("page_name", "last_synced_at").join(seed.select(F.col("page").alias("page_name")).distinct(), "page_name", "full_outer")
    joined = named.join(counts, named["page_name"] == counts["update_page"], "left").drop("update_page")
    return joined.select("page_name", F.col("last_synced_at").isNotNull().alias("was_read"), *[F.coalesce(s, F.lit(0)).alias(s) for s in STATUSES])


def process_queue(queue: DataFrame, pages: DataFrame, limit: int | None = None) -> DataFrame:
    """One cycle over pending rows: outcome(id, outcome, error_message) by whether their page is held and what it gave.

    pages(item_name, outcome): extracted, skipped or failed. A row without a page fails alone; no row stops another.
    """
    joined = pending_items(queue, limit).join(pages, "item_name", "left")
    result = F.when(F.col("outcome").isNull(), "failed").when(F.col("outcome") == "extracted", "complete").otherwise(F.col("outcome"))
    return joined.select("id", "item_name", result.alias("result"), F.when(F.col("outcome").isNull(), "page not held").alias("error"))


def sync_cycle(queue: DataFrame, links: DataFrame, pages: DataFrame, max_retries: int) -> DataFrame:
    """The queue after a whole cycle: failed rows reset, new links enqueued, pending rows processed."""
    ready = reset_failed(queue, max_retries)
    new = enqueue(ready, links).withColumn("id", F.xxhash64("item_name", "update_page"))
    every = ready.unionByName(new.drop("pos", "wiki_url"), allowMissingColumns=True)
    done = process_queue(every, pages).select("id", "result", "error")
    joined = every.join(done, "id", "left")
    failed = F.coalesce(F.col("result") == "failed", F.lit(False))
    return (
        joined.withColumn("status", F.coalesce("result", "status"))
        .withColumn("retry_count", F.col("retry_count") + F.when(failed, 1).otherwise(0))
        .withColumn("error_message", F.when(failed, F.col("error")).otherwise(F.col("error_message")))
        .drop("result", "error")
    )
