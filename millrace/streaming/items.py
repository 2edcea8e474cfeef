"""Extraction as a stream: pages that arrive become item records in a snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import page_key
from ..operators.items import extract_items
from ..operators.ledger import first_by
from ..sources.records import item_records
from ..sources.snapshots import newest, stream_name, upsert_snapshot


def stream_items(pages: DataFrame, root: str, checkpoint: str, *, registry: DataFrame | None = None, buckets: int = 64) -> StreamingQuery:
    """Extract a stream pages(url, html, fetched_at long, update) into the records at root, until nothing more is there.

    A micro-batch is one version of the table, made by the parse job over its pages. Its number stands in the manifest, so a batch that is
    replayed after a failure changes nothing twice. Of several fetches of an item the last one counts, in whatever batches they came; a
    fetch without a table leaves the item as it is. Of pages with one id in a batch the last fetched one counts.
    """
    spark = pages.sparkSession
    name = stream_name(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(page_key(F.col("url")).alias("key")).agg(F.max_by(F.struct("url", "html", "fetched_at", "update"), F.struct("fetched_at", "html")).alias("p")).select("p.*")
        found = extract_items(last.withColumn("page_id", F.col("fetched_at")), registry=registry)  # the key of a page carries its time
        updates = last.select(F.col("url").alias("_url"), "update")
        items = found.withColumn("fetched_at", F.col("page_key")).join(updates, F.col("wiki.url") == F.col("_url"))
        records = first_by(item_records(items, "fetched_at"), ["id"], F.desc("fetched_at"), "record")
        upsert_snapshot(spark, root, records, "id", newest("fetched_at", "id"), buckets=buckets, batch=(name, number))

    query = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
