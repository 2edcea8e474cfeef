"""Queries of the work ledger, with orders as the queue and customers' listings as its pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from .registry import register

_PAGE = "CASE WHEN o_custkey % 11 = 0 THEN 'Misc_' || substr(o_orderpriority, 1, 1) ELSE 'Update_' || CAST(o_custkey % 40 AS STRING) || '_named_items' END"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
QUEUE = f"""
SELECT o_orderkey AS id, 'item ' || CAST(o_orderkey AS STRING) AS item_name, {_PAGE} AS update_page,
  CASE o_orderkey % 6 WHEN 0 THEN 'complete' WHEN 1 THEN 'failed' WHEN 2 THEN 'in_progress' WHEN 3 THEN 'skipped' ELSE 'pending' END AS status,
  {_DAY} AS queued_at, CASE WHEN o_orderkey % 6 < 4 THEN {_DAY} END AS started_at,
  CASE WHEN o_orderkey % 6 IN (0, 1, 3) THEN {_DAY} END AS completed_at,
  CASE WHEN o_orderkey % 6 = 1 THEN 'boom' END AS error_message, CAST(o_orderkey % 5 AS BIGINT) AS retry_count
FROM {{orders}}"""
STATE = """
SELECT 'Update_' || CAST(c_custkey AS STRING) || '_named_items' AS page_name, 'u' || CAST(c_custkey AS STRING) AS page_url,
  CASE WHEN c_custkey % 3 > 0 THEN '2024-01-0' || CAST(c_custkey % 9 + 1 AS STRING) END AS last_synced_at,
  CASE WHEN c_custkey % 3 > 0 THEN c_custkey * 10 END AS revision_id
FROM {customer} WHERE c_custkey % 2 = 0"""
SEEN = """
SELECT 'Update_' || CAST(c_custkey AS STRING) || '_named_items' AS page_name, 'v' || CAST(c_custkey AS STRING) AS page_url,
  '2024-02-0' || CAST(c_custkey % 9 + 1 AS STRING) AS synced_at, c_custkey * 10 + c_custkey % 4 AS revision_id
FROM {customer} WHERE c_custkey % 3 <> 1"""
LINKS = """
SELECT 'item ' || CAST(l_orderkey AS STRING) AS item_name, 'Update_' || CAST(l_suppkey % 40 AS STRING) || '_named_items' AS update_page,
  'w' || CAST(l_partkey AS STRING) AS wiki_url, l_orderkey * 100 + l_linenumber AS pos
FROM {lineitem} WHERE l_partkey % 3 = 0"""
SEED = "SELECT DISTINCT 'Update_' || CAST(s_suppkey AS STRING) || '_named_items' AS page FROM {supplier}"
_NUMBER = r"TRY_CAST(nullif(regexp_extract({0}, '^Update_(\d+)_named_items$', 1), '') AS INTEGER)"

register(
    "register_listing",
    lambda state, seen: L.register_listings(state, seen.select("page_name", "page_url")).select("page_name", "page_url", "revision_id"),
    """SELECT page_name, page_url, revision_id FROM state UNION ALL
    SELECT page_name, min(page_url), NULL FROM seen WHERE page_name NOT IN (SELECT page_name FROM state) GROUP BY page_name""",
    state=STATE, seen=SEEN,
)
register(
    "mark_listing_synced",
    lambda state, seen: L.mark_synced(state, seen).select("page_name", "last_synced_at", "revision_id"),
    """SELECT s.page_name, coalesce(n.synced_at, s.last_synced_at) AS last_synced_at, CASE WHEN n.page_name IS NULL THEN s.revision_id ELSE n.revision_id END AS revision_id
    FROM state s LEFT JOIN seen n USING (page_name)""",
    state=STATE, seen=SEEN,
)
register("listing_status", lambda state: L.listing_status(state, "Update_4_named_items"), "SELECT * FROM state WHERE page_name = 'Update_4_named_items'", state=STATE)
register("list_listings", lambda state: L.list_listings(state).select("page_name", "n"), f"SELECT page_name, {_NUMBER.format('page_name')} AS n FROM state ORDER BY n NULLS LAST, page_name", state=STATE)
register(
    "enqueue",
    lambda queue, links: L.enqueue(queue, links).select("item_name", "update_page", "wiki_url", "status", "retry_count"),
    """SELECT item_name, update_page, arg_min(wiki_url, pos) AS wiki_url, 'pending' AS status, 0 AS retry_count FROM links l
    WHERE NOT EXISTS (FROM queue q WHERE q.item_name = l.item_name AND q.update_page = l.update_page) GROUP BY ALL""",
    queue=QUEUE, links=LINKS,
)
register(
    "pending_items",
    lambda queue: L.pending_items(queue, 100).select("id", "item_name", "update_page", "n"),
    f"SELECT id, item_name, update_page, {_NUMBER.format('update_page')} AS n FROM queue WHERE status = 'pending' ORDER BY n NULLS LAST, update_page, id LIMIT 100",
    queue=QUEUE,
)
_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in L.STATUSES)
register("queue_stats", L.queue_stats, f"SELECT {_COUNTS}, count(*) AS total FROM queue", queue=QUEUE)
register("listing_items", lambda queue: L.listing_items(queue, "Update_7_named_items"), "SELECT * FROM queue WHERE update_page = 'Update_7_named_items'", queue=QUEUE)
# Two status events for some rows, one for others; times are given by some.
EVENTS = f"""
SELECT o_orderkey AS id, 1 AS seq, 'in_progress' AS status, {_DAY} AS started_at, CAST(NULL AS STRING) AS completed_at FROM {{orders}} WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 4 = 0 THEN 'skipped' ELSE 'complete' END, NULL, '2024-03-01' FROM {{orders}} WHERE o_orderkey % 6 = 4"""
register(
    "apply_status",
    lambda queue, events: L.apply_status(queue, events).select("id", "status", "started_at", "completed_at"),
    """SELECT q.id, coalesce(e.status, q.status) AS status, coalesce(e.started_at, q.started_at) AS started_at, coalesce(e.completed_at, q.completed_at) AS completed_at
    FROM queue q LEFT JOIN (SELECT id, arg_max(status, seq) AS status, max(started_at) AS started_at, max(completed_at) AS completed_at FROM events GROUP BY id) e USING (id)""",
    queue=QUEUE, events=EVENTS,
)
FAILURES = """
SELECT l_orderkey AS id, l_linenumber + l_partkey * 10 AS seq, CAST(CAST(l_shipdate AS DATE) AS STRING) AS completed_at, 'line ' || CAST(l_partkey AS STRING) AS message
FROM {lineitem} WHERE l_suppkey % 5 = 0"""
register(
    "apply_failure",
    lambda queue, failures: L.apply_failures(queue, failures.distinct()).select("id", "status", "completed_at", "error_message", "retry_count"),
    """SELECT q.id, CASE WHEN f.n > 0 THEN 'failed' ELSE q.status END AS status, CASE WHEN f.n > 0 THEN f.last.completed_at ELSE q.completed_at END AS completed_at,
      CASE WHEN f.n > 0 THEN f.last.message ELSE q.error_message END AS error_message, (q.retry_count + coalesce(f.n, 0))::BIGINT AS retry_count
    FROM queue q LEFT JOIN (SELECT id, count(*) AS n, max({seq: seq, completed_at: completed_at, message: message}) AS last FROM (SELECT DISTINCT * FROM failures) GROUP BY id) f USING (id)""",
    queue=QUEUE, failures=FAILURES,
)
_AGAIN = "coalesce(status = 'failed' AND retry_count < 3, false)"
register(
    "reset_failed",
    lambda queue: L.reset_failed(queue, 3).select("id", "status", "started_at", "completed_at", "retry_count"),
    f"SELECT id, CASE WHEN {_AGAIN} THEN 'pending' ELSE status END AS status, CASE WHEN NOT {_AGAIN} THEN started_at END AS started_at, CASE WHEN NOT {_AGAIN} THEN completed_at END AS completed_at, retry_count FROM queue",
    queue=QUEUE,
)
register("listing_cascade", lambda queue, state: L.listing_cascade(queue, state).select("id", "update_page"), "SELECT id, update_page FROM queue WHERE update_page IN (SELECT page_name FROM state)", queue=QUEUE, state=STATE)
register(
    "queue_view",
    lambda queue: L.queue_view(queue).select("update_page", "pending", "n"),
    f"SELECT update_page, count(*) FILTER (status = 'pending') AS pending, {_NUMBER.format('update_page')} AS n FROM queue GROUP BY update_page",
    queue=QUEUE,
)
register(
    "next_batch",
    lambda queue, seed: L.next_batch(queue, seed, 10_000_000),
    f"""SELECT update_page AS page, {_NUMBER.format('update_page')} AS n FROM queue GROUP BY 1 HAVING count(*) FILTER (status = 'pending') > 0
    UNION ALL (SELECT page, {_NUMBER.format('page')} AS n FROM seed WHERE page NOT IN (SELECT update_page FROM queue) AND (SELECT count(*) FROM queue WHERE status = 'pending') < 10000000 ORDER BY n NULLS LAST, page LIMIT 1)""",
    queue=QUEUE, seed=SEED,
)
register(
    "sync_status",
    L.sync_status,
    f"""SELECT p.page_name, s.last_synced_at IS NOT NULL AS was_read, {", ".join(f"coalesce(c.{s}, 0) AS {s}" for s in L.STATUSES)}
    FROM (SELECT page_name FROM state UNION SELECT page FROM seed) p LEFT JOIN state s USING (page_name)
    LEFT JOIN (SELECT update_page, {_COUNTS} FROM queue GROUP BY update_page) c ON c.update_page = p.page_name""",
    queue=QUEUE, state=STATE, seed=SEED,
)
HELD = """
SELECT 'item ' || CAST(o_orderkey AS STRING) AS item_name, CASE o_custkey % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' ELSE 'extracted' END AS outcome
FROM {orders} WHERE o_orderkey % 10 <> 4"""
_RESULT = "CASE WHEN h.outcome IS NULL THEN 'failed' WHEN h.outcome = 'extracted' THEN 'complete' ELSE h.outcome END"
_ERROR = "CASE WHEN h.outcome IS NULL THEN 'page not held' END"
register(
    "queue_process",
    lambda queue, held: L.process_queue(queue, held),
    f"SELECT q.id, q.item_name, {_RESULT} AS result, {_ERROR} AS error FROM queue q LEFT JOIN held h USING (item_name) WHERE q.status = 'pending'",
    queue=QUEUE, held=HELD,
)
register(
    "sync_cycle",
    lambda queue, links, held: L.sync_cycle(queue, links, held, 3).groupBy("update_page", "status", "error_message").agg(F.count("*").alias("n"), F.sum("retry_count").alias("retries")),
    f"""WITH ready AS (SELECT item_name, update_page, CASE WHEN {_AGAIN} THEN 'pending' ELSE status END AS status, error_message, retry_count FROM queue
      UNION ALL SELECT DISTINCT item_name, update_page, 'pending', NULL, 0 FROM links l WHERE NOT EXISTS (FROM queue q WHERE q.item_name = l.item_name AND q.update_page = l.update_page)),
    done AS (SELECT r.*, CASE WHEN r.status = 'pending' THEN {_RESULT} END AS result FROM ready r LEFT JOIN held h USING (item_name))
    SELECT d.update_page, coalesce(d.result, d.status) AS status, CASE WHEN d.result = 'failed' THEN (CASE WHEN h.outcome IS NULL THEN 'page not held' END) ELSE d.error_message END AS error_message,
      count(*) AS n, sum(d.retry_count + (coalesce(d.result, '') = 'failed')::INT)::BIGINT AS retries
    FROM done d LEFT JOIN held h USING (item_name) GROUP BY ALL""",
    queue=QUEUE, links=LINKS, held=HELD,
)
