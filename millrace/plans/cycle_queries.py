"""Queries of the whole cycle and of extraction as a stream: pages in, item records, reports and the next queue out of snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cycle import NO_CONTENT, NO_TABLE, NOT_HELD, SKIP, commit, run_cycle
from ..sources.records import scan_records
from ..sources.snapshots import read_snapshot
from ..streaming.items import stream_items
from ..workers import shared
from .page_queries import _MINTED, _N
from .registry import ORACLES, QUERIES, relation
from .text_queries import HOST

_URL = f"'https://{HOST}/page/Item:P' || CAST(p_partkey AS STRING)"
_META = "'<html><script>X={{{{' || CASE p_partkey % 13 WHEN 0 THEN '' ELSE '\"wgArticleId\":' || CAST(p_partkey + 7 AS STRING) || ',' END || '\"wgCategories\":[\"' || CASE p_partkey % 10 WHEN 8 THEN 'Raw ingredients' ELSE 'Rings' END || '\"]}}}};</script><h1 id=\"firstHeading\">Item:' || p_name || '</h1>'"
_TABLE = "'<table><tr><th>Item Type</th><td>Jewelry / Ring</td></tr><tr><th>Minimum Level</th><td>' || {level} || '</td></tr><tr><th>Odd</th><td>' || p_brand || '</td></tr></table>'"
# Pages by the key modulo 10: without content, without a table, of no equipment, not held; every 13th without a page id.
_HTML = f"{_META} || CASE p_partkey % 10 WHEN 6 THEN '<p>gone</p>' WHEN 7 THEN '<div class=\"mw-parser-output\">none</div>' WHEN 8 THEN '<div class=\"mw-parser-output\">none</div>' ELSE '<div class=\"mw-parser-output\">' || {_TABLE.format(level=_N)} || '</div>' END"
PAGES = f"SELECT {_URL} AS url, {_HTML} AS html, CAST(1 AS BIGINT) AS fetched_at FROM {{part}} WHERE p_partkey % 10 <> 9"
QUEUE = f"""SELECT CAST(p_partkey AS BIGINT) AS id, 'P' || CAST(p_partkey AS STRING) AS item_name, CASE p_partkey % 3 WHEN 0 THEN 'Odd' ELSE 'Update_' || {_N} || '_named_items' END AS update_page, replace({_URL}, 'Item:', 'Item%3A') AS wiki_url,
  CASE p_partkey % 8 WHEN 2 THEN 'failed' WHEN 6 THEN 'failed' WHEN 3 THEN 'complete' ELSE 'pending' END AS status, CAST(NULL AS TIMESTAMP) AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at, CAST(NULL AS STRING) AS error_message,
  CAST(CASE p_partkey % 8 WHEN 2 THEN 1 WHEN 6 THEN 3 ELSE 0 END AS BIGINT) AS retry_count FROM {{part}}"""


def _sync_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared(spark, "cycle")
    registry = relation(spark, sf_dir, "SELECT 'known' || CAST(p_partkey AS STRING) AS id, CAST(p_partkey + 7 AS BIGINT) AS page_id, 'old' AS title FROM {part} WHERE p_partkey % 5 = 1")
    commit(spark, root, run_cycle(relation(spark, sf_dir, QUEUE), relation(spark, sf_dir, PAGES).repartition("url"), registry, F.lit("2026-01-01").cast("timestamp")), buckets=4)
    queue = read_snapshot(spark, f"{root}/queue").select(F.lit("queue").alias("what"), F.col("id").cast("string").alias("key"), F.concat_ws("|", "status", F.coalesce("error_message", F.lit("-")), "retry_count").alias("value"))
    items = scan_records(spark, f"{root}/items").select(F.lit("item"), F.get_json_object("record", "$.wiki.page_id"), "path")
    reports = read_snapshot(spark, f"{root}/reports").select(F.lit("report"), "report", F.concat_ws("|", "name", F.coalesce("skipped", F.lit("-")), F.size("unmapped"), F.size("errors")))
    titles = read_snapshot(spark, f"{root}/registry").select(F.lit("id"), F.col("page_id").cast("string"), F.concat_ws("|", "id", "title"))
    return queue.union(items).union(reports).union(titles)


_UPDATE = "CASE p_partkey % 3 WHEN 0 THEN 'unknown' ELSE 'update-' || p_size END"
_OUTCOME = f"CASE p_partkey % 10 WHEN 6 THEN '{NO_CONTENT}' WHEN 7 THEN '{NO_TABLE}' WHEN 9 THEN '{NOT_HELD}' END"
_ID = f"CASE WHEN p_partkey % 5 = 1 THEN 'known' || p_partkey ELSE {_MINTED} END"

QUERIES["sync_pages"] = _sync_pages
ORACLES["sync_pages"] = f"""
WITH p AS (SELECT *, {_OUTCOME} AS failed, p_partkey % 8 IN (2, 6) AS again, md5('catalog|' || (p_partkey + 7)::VARCHAR) AS h FROM part WHERE p_partkey % 8 NOT IN (3, 6))
SELECT 'queue' AS what, p_partkey::VARCHAR AS key, CASE WHEN failed IS NULL THEN 'complete|-|' ELSE 'failed|' || failed || '|' END || (again::INT + (failed IS NOT NULL)::INT) AS value FROM p
UNION ALL SELECT 'item', (p_partkey + 7)::VARCHAR, {_UPDATE} || '/jewelry/' || {_ID} || '-' || replace(p_name, ' ', '-') || '.json' FROM p WHERE failed IS NULL AND p_partkey % 10 <> 8 AND p_partkey % 13 > 0
UNION ALL SELECT 'report', {_UPDATE} || '|Item:P' || p_partkey, CASE p_partkey % 10 WHEN 8 THEN 'P' || p_partkey || '|{SKIP}Raw ingredients|0|0' ELSE p_name || '|-|1|' || (p_partkey % 13 = 0)::INT END FROM p WHERE failed IS NULL
UNION ALL SELECT 'id', (p_partkey + 7)::VARCHAR, {_ID} || '|Item:' || p_name FROM p WHERE failed IS NULL AND p_partkey % 10 <> 8 AND p_partkey % 13 > 0
"""

# A third of the pages is fetched again: a later fetch in a later batch, an earlier one that comes late.
_FETCH = f"SELECT {_URL} AS url, {_META} || '<div class=\"mw-parser-output\">' || {_TABLE} || '</div>' AS html, CAST({{at}} AS BIGINT) AS fetched_at, 'update-' || {_N} AS update FROM {{{{part}}}} WHERE p_partkey % 10 < 6 AND p_partkey % 13 > 0"


def _stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, root, checkpoint = shared(spark, "fetched"), shared(spark, "stream"), shared(spark, "checkpoint")
    part = lambda level, at, which: relation(spark, sf_dir, _FETCH.replace("{{{{", "\0").replace("}}}}", "\1").replace("{{part}}", "{part}").replace("{level}", level).replace("{at}", at).replace("\0", "{{").replace("\1", "}}") + which)
    first = part(_N, "5", " AND p_partkey % 2 = 0").coalesce(1)
    later = part("'30'", "9", " AND p_partkey % 6 = 0").unionByName(part("'40'", "2", " AND p_partkey % 6 = 2")).coalesce(1)
    second = part(_N, "5", " AND p_partkey % 2 = 1").coalesce(1)
    for fetched in (first, second, later):  # a run each; the last finds the refetched pages only
        fetched.write.mode("append").parquet(source)
        if fetched is not first:
            stream = spark.readStream.schema("url string, html string, fetched_at long, update string").option("maxFilesPerTrigger", 1).parquet(source)
            stream_items(stream, root, checkpoint, buckets=4)
    record = F.from_json("record", "id string, name string, minimum_level bigint").alias("r")
    return scan_records(spark, root).select("path", record).select("path", "r.*")


QUERIES["stream_extract"] = _stream_extract
ORACLES["stream_extract"] = f"""
WITH p AS (SELECT *, md5('catalog|' || (p_partkey + 7)::VARCHAR) AS h FROM part WHERE p_partkey % 10 < 6 AND p_partkey % 13 > 0)
SELECT 'update-' || p_size || '/jewelry/' || {_MINTED} || '-' || replace(p_name, ' ', '-') || '.json' AS path, {_MINTED} AS id, p_name AS name, CASE WHEN p_partkey % 6 = 0 THEN 30 ELSE p_size END::BIGINT AS minimum_level FROM p
"""
