"""Queries of sources, reports, samples, planning, log analysis and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis as A
from ..operators import ledger as L
from ..operators.shapes import SHAPES
from ..sources import tables as S
from ..streaming import guard as G
from ..workers import shared
from .ledger_queries import QUEUE, SEED
from .registry import ORACLES, QUERIES, register, relation

# Documents as reports: language as template, words of the source as rules.
REPORTS = "SELECT doc_id AS page, lang AS template, source, n_chars FROM {documents}"
register("report_totals", lambda reports: A.report_counts(reports, "template"), "SELECT template AS value, count(*) AS n FROM reports GROUP BY 1", reports=REPORTS)
register(
    "report_rule_totals", lambda reports: A.report_map_sum(reports.withColumn("hits", F.map_from_arrays(F.array("source", "template"), F.array(F.lit(1).cast("bigint"), F.col("n_chars")))), "hits"),
    "SELECT value, sum(k)::BIGINT AS n FROM (SELECT source AS value, 1 AS k FROM reports UNION ALL SELECT template, n_chars FROM reports) GROUP BY value",
    reports=REPORTS,
)
register("report_unmapped", lambda reports: A.report_pages(reports, "page", F.array("source")), "SELECT source AS value, page, count(*) AS n FROM reports GROUP BY ALL", reports=REPORTS)
register("report_unclassified", lambda reports: A.report_pages(reports, "page", F.array("template", "source", "template")), "SELECT value, page, count(*) AS n FROM (SELECT page, unnest([template, source, template]) AS value FROM reports) GROUP BY ALL", reports=REPORTS)
GAPS = "SELECT doc_id AS page, 'toxic' AS kind, CAST(toxic AS STRING) AS value FROM {labels} WHERE toxic = 1 OR quality = 0"
BASE = "SELECT doc_id AS page, 'toxic' AS kind, CAST(quality AS STRING) AS value FROM {labels} WHERE doc_id % 2 = 0"
HELD = "SELECT doc_id AS page FROM {documents} WHERE doc_id % 3 > 0"
register(
    "gap_baseline_diff", A.gap_diff,
    """SELECT page, kind, value, CASE WHEN b.page IS NULL THEN 'new' ELSE 'fixed' END AS change FROM (SELECT DISTINCT *, 1 AS g FROM gaps) g
    FULL JOIN (SELECT DISTINCT *, 1 AS b FROM baseline WHERE page IN (SELECT page FROM held)) b USING (page, kind, value) WHERE g IS NULL OR b IS NULL""".replace("b.page IS NULL", "b.b IS NULL").replace("WHERE g IS NULL OR b IS NULL", "WHERE g.g IS NULL OR b.b IS NULL"),
    gaps=GAPS, baseline=BASE, held=HELD,
)
register("gap_baseline_update", A.gap_update, "SELECT DISTINCT page, kind, value FROM gaps UNION ALL SELECT page, kind, value FROM baseline WHERE page NOT IN (SELECT page FROM held)", gaps=GAPS, baseline=BASE, held=HELD)
ROWS = "SELECT doc_id, source FROM {documents}"
_SAMPLE = """SELECT doc_id, source, round FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('1|' || doc_id::VARCHAR), doc_id)::INTEGER AS round FROM rows) ORDER BY round, md5('1|' || source), source LIMIT 50"""
register("stratified_sample", lambda rows: A.stratified_sample(rows, "doc_id", "source", 50, 1), _SAMPLE, rows=ROWS)
OUTCOMES = "SELECT doc_id, CASE WHEN quality = 1 THEN 'extracted' ELSE 'failed' END AS outcome FROM {labels}"
register("sample_outcome", lambda rows, outcomes: A.sample_outcome(A.stratified_sample(rows, "doc_id", "source", 50, 1), outcomes, "doc_id").select("doc_id", "outcome", "error"), f"SELECT doc_id, outcome, CASE WHEN outcome IS NULL THEN 'page not held' END AS error FROM ({_SAMPLE}) LEFT JOIN outcomes USING (doc_id)", rows=ROWS, outcomes=OUTCOMES)
WANTED = "SELECT p_name || CAST(p_partkey AS STRING) AS title FROM {part}"
THERE = "SELECT p_name || CAST(p_partkey AS STRING) AS title, p_type, CAST(p_partkey % 3 AS BIGINT) AS fetched_at, p_partkey AS seq FROM {part} WHERE p_partkey % 4 = 0"
register("fetch_budget", lambda wanted, there: A.fetch_budget(wanted, there, "title", 76, 3), "SELECT u AS unheld, (1 + 2 * u + least(u, 76)) * 4 AS worst_case FROM (SELECT count(DISTINCT title) AS u FROM wanted WHERE title NOT IN (SELECT title FROM there))", wanted=WANTED, there=THERE)
register(
    "batch_preview", lambda queue: L.pending_items(L.reset_failed(queue, 3), 200).select("id", "update_page", "n"),
    r"""SELECT id, update_page, TRY_CAST(nullif(regexp_extract(update_page, '^Update_(\d+)_named_items$', 1), '') AS INTEGER) AS n FROM queue
    WHERE status = 'pending' OR (status = 'failed' AND retry_count < 3) ORDER BY n NULLS LAST, update_page, id LIMIT 200""",
    queue=QUEUE,
)

# Events as a run log: a user is a run.
LOG = """
SELECT CAST(user_id AS STRING) AS run, event_id AS seq, CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'throttle' ELSE 'failed' END WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'stored' ELSE 'plain' END
  WHEN 'view' THEN 'completed' WHEN 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 'skipped' ELSE 'browser' END ELSE CASE WHEN event_id % 2 = 0 THEN 'request' ELSE 'challenge' END END AS kind FROM {events}"""
register("log_tally", A.log_tally, "SELECT run, count(*) FILTER (kind = 'request') AS request, count(*) FILTER (kind = 'completed') AS completed, count(*) FILTER (kind = 'failed') AS failed, count(*) FILTER (kind = 'skipped') AS skipped FROM log GROUP BY run", log=LOG)
_STREAK = """SELECT run, min(seq) AS seq FROM (SELECT run, seq, sum((kind = 'throttle')::INT) OVER (PARTITION BY run, g ORDER BY seq) AS streak FROM
  (SELECT *, sum((kind <> 'throttle')::INT) OVER (PARTITION BY run ORDER BY seq) AS g FROM log WHERE kind IN ('throttle', 'stored', 'plain'))) WHERE streak = 3 GROUP BY run"""
register("throttle_streak", A.throttle_streak, _STREAK, log=LOG)
_RATE = """SELECT run, min(seq) AS seq FROM (SELECT run, seq, sum((kind = 'failed')::INT) OVER w AS failed, count(*) OVER w AS processed FROM log WHERE kind IN ('completed', 'failed', 'skipped') WINDOW w AS (PARTITION BY run ORDER BY seq))
  WHERE failed >= 3 AND failed * 10 > processed GROUP BY run"""
register("failure_rate_stop", A.failure_rate_stop, _RATE, log=LOG)
register(
    "challenge_switch", A.challenge_switch,
    """SELECT run, min(seq) AS seq FROM (SELECT *, sum(c) OVER (PARTITION BY run, g ORDER BY seq) AS streak FROM (SELECT run, seq, c, sum(1 - c) OVER w AS g, count(*) OVER w AS f, sum(c) OVER w AS n
      FROM (SELECT *, (kind = 'challenge')::INT AS c FROM log WHERE kind IN ('challenge', 'plain', 'stored')) WINDOW w AS (PARTITION BY run ORDER BY seq))) WHERE streak >= 3 OR (f >= 10 AND n > 0.2 * f) GROUP BY run""",
    log=LOG,
)
LINES = "SELECT CAST(user_id AS STRING) AS run, event_id AS seq, chr(27) || '[32m2024-01-01 | INFO | ' || event_type || ' | ' || CAST(value AS STRING) || chr(27) || '[0m' AS line, event_type FROM {events}"
register("scan_log", S.scan_log, "SELECT run, seq, regexp_replace(replace(line, chr(27) || '[32m2024-01-01 | INFO | ', ''), chr(27) || '\\[0m$', '') AS message FROM lines", lines=LINES)

# Sources.
register("scan_pages", lambda there: S.scan_pages(there).select("title", "p_type"), "SELECT title, p_type FROM there ORDER BY title", there=THERE)
register("page_lookup", lambda there: S.page_lookup(there, "small ring0").select("title", "p_type"), "SELECT title, p_type FROM there WHERE title = 'small ring0'", there=THERE)
register("page_lookup_name", lambda there: S.page_lookup_name(there, " SMALL ring0").select("title"), "SELECT title FROM there WHERE lower(title) = 'small ring0' ORDER BY title LIMIT 1", there=THERE)
register("held_unheld", S.held_unheld, "SELECT title, title IN (SELECT title FROM pages) AS held FROM requested", requested=WANTED, pages=THERE)
register("missing_files", S.missing_files, "SELECT * FROM index WHERE file NOT IN (SELECT file FROM files)", index="SELECT p_partkey AS file, p_name AS title FROM {part}", files="SELECT DISTINCT l_partkey AS file FROM {lineitem} WHERE l_partkey % 3 > 0")
FETCHED = "SELECT p_name || CAST(p_partkey AS STRING) AS title, 'new' AS p_type, CAST(p_partkey % 5 AS BIGINT) AS fetched_at, p_partkey + 1 AS seq FROM {part} WHERE p_partkey % 6 = 0"
register("upsert_pages", S.upsert_pages, "SELECT title, p_type, fetched_at, seq FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY fetched_at DESC, seq DESC) AS rn FROM (FROM held UNION ALL FROM fetched)) WHERE rn = 1", held=THERE, fetched=FETCHED)
OLD = "SELECT 'update-' || CAST(p_size AS STRING) AS update, p_name AS page_key, p_partkey AS seq, p_type AS line FROM {part} WHERE p_partkey % 2 = 0"
register("write_reports", S.write_reports, "SELECT update, page_key, seq, line FROM (SELECT *, row_number() OVER (PARTITION BY update, page_key ORDER BY seq DESC) AS rn FROM (FROM old UNION ALL FROM new)) WHERE rn = 1", old=OLD, new=OLD.replace("% 2 = 0", "% 3 = 0"))


def _scan_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared(spark, "seed")
    relation(spark, sf_dir, SEED).select(F.concat(F.lit("  - "), "page", F.lit("  # listing")).alias("value")).repartition(4).write.text(folder)
    return S.scan_seed(spark, folder).select("page")


def _scan_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of runs as files, each in the order of its events, read in splits: message and place of every line."""
    folder = shared(spark, "logs")
    rows = relation(spark, sf_dir, LINES).withColumn("run", F.expr("cast(run as bigint) % 5"))
    rows.repartition("run").sortWithinPartitions("run", "seq").select("run", F.col("line").alias("value")).write.partitionBy("run").text(folder)
    read = S.text_lines(spark, folder).select(F.regexp_extract("path", "/run=([^/]*)/", 1).alias("run"), F.col("pos").alias("seq"), "line")
    return S.scan_log(read)


def _write_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared(spark, "registry")
    S.write_registry(relation(spark, sf_dir, "SELECT c_mktsegment AS id, c_custkey AS page_id, c_name AS title FROM {customer}"), folder)
    return spark.read.schema("id string, page_id bigint, title string").json(folder)


def _write_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared(spark, "items")
    rows = relation(spark, sf_dir, "SELECT p_partkey AS id, p_name AS name, p_type AS category, 'update-' || CAST(p_size AS STRING) AS update FROM {part}")
    S.write_items(None, rows, folder)
    later = shared(spark, "items")
    changed = rows.where("id % 7 = 0").withColumns({"name": F.upper("name"), "category": F.lit("other"), "update": F.lit("update-9")})
    S.write_items(spark.read.parquet(folder), changed, later)
    return spark.read.parquet(later).select("id", "name", F.col("category").cast("string"), F.col("update").cast("string"))


def _scan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared(spark, "catalog")
    rows = relation(spark, sf_dir, "SELECT p_partkey % 4 AS category, p_partkey AS id, p_name AS name FROM {part}")
    rows.repartition("category").write.partitionBy("category").json(folder)
    records = S.scan_items(spark, folder).select(F.substring_index("path", "/", 1).alias("folder"), F.explode(F.split(F.btrim("record", F.lit("\n")), "\n")).alias("record"))
    return records.select("folder", F.from_json("record", "id bigint, name string").alias("r")).select("folder", "r.*")


def _scan_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared(spark, "bundle")
    for name, sql in (("servers", "SELECT lower(s_name) AS key, s_name AS name FROM {supplier}"), ("effects", "SELECT p_type AS key, p_name AS name FROM {part}")):
        relation(spark, sf_dir, sql).write.json(f"{folder}/{name}.json")
    tables, missing = S.scan_bundle(spark, folder, dict.fromkeys(SHAPES, "key string, name string"))
    found = [t.select(F.lit(n).alias("table_name"), "key", "name") for n, t in tables.items()]
    return reduce(DataFrame.union, [*found, missing.select(F.col("name").alias("table_name"), F.lit(None).cast("string"), F.lit("missing"))])


QUERIES |= {"scan_log_files": _scan_log_files, "scan_seed": _scan_seed, "write_registry": _write_registry, "write_items": _write_items, "scan_items": _scan_items, "scan_bundle": _scan_bundle}
ORACLES |= {
    "scan_log_files": f"""SELECT (run::BIGINT % 5)::VARCHAR AS run, row_number() OVER (PARTITION BY run::BIGINT % 5 ORDER BY seq) - 1 AS seq,
      regexp_replace(replace(line, chr(27) || '[32m2024-01-01 | INFO | ', ''), chr(27) || '\\[0m$', '') AS message FROM ({LINES.format(events='events')})""",
    "scan_seed": "SELECT DISTINCT 'Update_' || s_suppkey::VARCHAR || '_named_items' AS page FROM supplier",
    "write_registry": "SELECT c_mktsegment AS id, c_custkey AS page_id, c_name AS title FROM customer",
    "write_items": "SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE p_name END AS name, CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE p_type END AS category, 'update-' || (CASE WHEN p_partkey % 7 = 0 THEN least(p_size, 9) ELSE p_size END)::VARCHAR AS update FROM part",
    "scan_items": "SELECT 'category=' || (p_partkey % 4)::VARCHAR AS folder, p_partkey AS id, p_name AS name FROM part",
    "scan_bundle": "SELECT 'servers' AS table_name, lower(s_name) AS key, s_name AS name FROM supplier UNION ALL SELECT 'effects', p_type, p_name FROM part UNION ALL SELECT unnest(['items', 'bonus_types', 'option_lists', 'redirects', 'slot_compat', 'meta']), NULL, 'missing'",
}


def _stream_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events reach the stream up to a day after their time, in four runs of it; the last brings a row without a run, far ahead."""
    folder, target, checkpoint = shared(spark, "log"), shared(spark, "stops"), shared(spark, "guard")
    log = relation(spark, sf_dir, LOG.replace(" FROM {events}", ", CAST(ts AS TIMESTAMP) AS at FROM {events}"))
    came = F.unix_seconds("at") + F.pmod(F.xxhash64("seq"), F.lit(86_400))
    first, last = (x or 0 for x in log.agg(F.min(came), F.max(came)).first())
    runs = 4
    for k in range(runs):
        begun, over = (first + (last - first) * x // runs for x in (k, k + 1))
        rows = log.where((came >= begun) & ((came < over) | F.lit(k == runs - 1)))
        if k == runs - 1:
            ahead = F.timestamp_seconds(F.lit(last + 10 * 86_400))
            rows = rows.unionByName(spark.range(1).select(ahead.alias("at")), allowMissingColumns=True)
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema("run string, seq long, kind string, at timestamp").parquet(folder)
        query = G.stream_guard(stream, "2 days", 21_600).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(G.OUTPUT).parquet(target)


QUERIES["stream_guard"] = _stream_guard
ORACLES |= {
    "stream_guard": f"""WITH log AS ({LOG.format(events="events")}), stops AS (SELECT run, seq, 'throttled' AS reason, 0 AS k FROM ({_STREAK}) UNION ALL SELECT run, seq, 'failures', 1 FROM ({_RATE}))
    SELECT run, seq, reason FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq, k) AS rn FROM stops) WHERE rn = 1""",
}
