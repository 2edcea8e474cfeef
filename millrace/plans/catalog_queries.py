"""Queries of the registry, keyed upserts, link policy, integrity checks and bundle checks."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import quality as Q
from ..operators import robots as R
from ..operators.shapes import shape_problems
from .registry import register
from .text_queries import HOST

_UUID = "substr(md5('{0}|' || CAST({1} AS STRING)), 1, 8) || '-' || substr(md5('{0}|' || CAST({1} AS STRING)), 9, 4) || '-4' || substr(md5('{0}|' || CAST({1} AS STRING)), 14, 3) || '-a' || substr(md5('{0}|' || CAST({1} AS STRING)), 18, 3) || '-' || substr(md5('{0}|' || CAST({1} AS STRING)), 21, 12)"
REGISTRY = f"SELECT {_UUID.format('old', 'c_custkey')} AS id, c_custkey AS page_id, c_name AS title FROM {{customer}} WHERE c_custkey % 3 > 0"
ITEMS = """
SELECT CASE WHEN o_orderkey % 50 > 0 THEN o_custkey END AS page_id, 'Item ' || CAST(o_orderkey % 3 AS STRING) AS title, o_orderkey AS seq FROM {orders}"""
register("registry_match", lambda items, registry: C.registry_match(items, registry).select("page_id", "seq", "id"), "SELECT i.page_id, i.seq, r.id FROM items i LEFT JOIN registry r USING (page_id)", items=ITEMS, registry=REGISTRY)
_MINT = _UUID.format("catalog", "page_id")
register(
    "registry_mint", C.registry_mint,
    f"SELECT {_MINT} AS id, page_id, arg_max(title, seq) AS title FROM items WHERE page_id IS NOT NULL AND page_id NOT IN (SELECT page_id FROM registry) GROUP BY page_id",
    items=ITEMS, registry=REGISTRY,
)
register(
    "registry_rename", C.registry_rename,
    f"""SELECT coalesce(r.id, {_MINT}) AS id, page_id, coalesce(n.title, r.title) AS title FROM registry r
    FULL JOIN (SELECT page_id, arg_max(title, seq) AS title FROM items WHERE page_id IS NOT NULL GROUP BY page_id) n USING (page_id)""",
    items=ITEMS, registry=REGISTRY,
)
# Registry lines: one defect in every seventh.
LINES = f"""
SELECT CAST(c_custkey AS BIGINT) AS line_no, CASE c_custkey % 14 WHEN 1 THEN '' WHEN 3 THEN '[1, 2]' WHEN 5 THEN '{{{{"id": "x", "page_id": 1}}}}'
  WHEN 7 THEN '{{{{"id": "no-uuid", "page_id": ' || CAST(c_custkey AS STRING) || ', "title": "t"}}}}'
  WHEN 9 THEN '{{{{"id": "' || {_UUID.format("l", "c_custkey")} || '", "page_id": "7", "title": "t"}}}}'
  WHEN 11 THEN '{{{{"id": "' || {_UUID.format("l", "c_custkey")} || '", "page_id": ' || CAST(c_custkey - 1 AS STRING) || ', "title": "t"}}}}'
  WHEN 13 THEN '{{{{"id": "' || {_UUID.format("l", "(c_custkey - 1)")} || '", "page_id": ' || CAST(c_custkey AS STRING) || ', "title": "t"}}}}'
  ELSE '{{{{"id": "' || {_UUID.format("l", "c_custkey")} || '", "page_id": ' || CAST(c_custkey AS STRING) || ', "title": "t"}}}}' END AS value FROM {{customer}}"""
_LINE_SQL = f"""SELECT line_no, CASE WHEN json_type(j) <> 'OBJECT' THEN 'not an object' WHEN list_sort(json_keys(j)) <> ['id', 'page_id', 'title'] THEN 'wrong keys'
    WHEN NOT regexp_matches(j->>'$.id', '{C.UUID4}') THEN 'bad id' WHEN p IS NULL THEN 'bad page_id' WHEN pn > 1 THEN 'page_id again' WHEN i > 1 THEN 'id again' END AS problem
  FROM (SELECT *, CASE WHEN p IS NOT NULL THEN row_number() OVER (PARTITION BY p ORDER BY line_no) END AS pn, CASE WHEN x IS NOT NULL THEN row_number() OVER (PARTITION BY x ORDER BY line_no) END AS i
    FROM (SELECT line_no, value::JSON AS j, CASE WHEN json_type(value::JSON, '$.page_id') IN ('UBIGINT', 'BIGINT') THEN (value::JSON->>'$.page_id')::BIGINT END AS p, value::JSON->>'$.id' AS x FROM lines WHERE trim(value) <> ''))"""
register("registry_defects", C.registry_defects, f"SELECT * FROM ({_LINE_SQL}) WHERE problem IS NOT NULL", lines=LINES)
register("scan_registry", lambda lines: lines.where("trim(value) <> ''").join(C.registry_defects(lines), "line_no", "left_anti").select("line_no", F.get_json_object("value", "$.id").alias("id")), f"SELECT line_no, json_extract_string(value, '$.id') AS id FROM lines WHERE line_no IN (SELECT line_no FROM ({_LINE_SQL}) WHERE problem IS NULL)", lines=LINES)
register(
    "null_page_id",
    lambda items: C.split_null_page_id(items.withColumn("errors", F.create_map(F.lit("a"), F.lit("b")))).groupBy("storable", F.array_sort(F.map_keys("errors")).alias("keys")).agg(F.count("*").alias("n")),
    "SELECT page_id IS NOT NULL AS storable, CASE WHEN page_id IS NULL THEN ['a', 'wiki.page_id'] ELSE ['a'] END AS keys, count(*) AS n FROM items GROUP BY ALL",
    items=ITEMS,
)
LISTED = "SELECT l_partkey AS id, CASE WHEN l_suppkey % 9 = 0 THEN 'unknown' ELSE 'update-' || CAST(l_suppkey AS STRING) END AS update FROM {lineitem}"
register(
    "introduced_update", C.introduced_update,
    r"""SELECT id, coalesce('update-' || min(n)::VARCHAR, 'unknown') AS update, min(n) AS n FROM (SELECT id, TRY_CAST(nullif(regexp_extract(update, '^update-(\d+)$', 1), '') AS INTEGER) AS n FROM listed) GROUP BY id""",
    listed=LISTED,
)
MOVES = "SELECT l_partkey AS id, l_shipmode AS path, l_orderkey * 10 + l_linenumber AS seq FROM {lineitem}".replace("l_shipmode", "'p' || CAST(l_suppkey % 3 AS STRING)")
register(
    "one_row_per_id", lambda moves: C.one_row_per_id(moves),
    """SELECT id, path, seq, coalesce(before <> path, false) AS moved FROM (SELECT *, lag(path) OVER (PARTITION BY id ORDER BY seq, path) AS before,
      row_number() OVER (PARTITION BY id ORDER BY seq DESC, path DESC) AS rn FROM moves) WHERE rn = 1""",
    moves=MOVES,
)
OUTCOMES = "SELECT o_orderkey AS page_id, CASE o_custkey % 3 WHEN 0 THEN 'skipped' WHEN 1 THEN 'failed' ELSE 'extracted' END AS outcome FROM {orders}"
register("skip_report", C.skip_reports, "SELECT page_id, outcome, outcome = 'extracted' AS has_item, outcome IN ('extracted', 'skipped') AS has_report FROM outcomes", outcomes=OUTCOMES)
REPORTS = f"SELECT p_partkey AS id, 'https://{HOST}/page/' || replace(p_name, ' ', CASE WHEN p_partkey % 2 = 0 THEN '_' ELSE '%20' END) || CAST(p_partkey AS STRING) AS url FROM {{part}}"
QUEUED = f"SELECT 'https://{HOST}/page/' || replace(p_name, ' ', '_') || CAST(p_partkey AS STRING) AS wiki_url, 'Update_' || CAST(p_size AS STRING) AS update_page FROM {{part}} WHERE p_partkey % 4 < 3"
_KEY = "replace(url_decode(list_last(string_split({0}, '/page/'))), ' ', '_')"
register(
    "tag_reports",
    lambda reports, queued: C.tag_reports(reports, queued),
    f"SELECT r.id, r.url, q.update_page FROM reports r LEFT JOIN queued q ON {_KEY.format('r.url')} = {_KEY.format('q.wiki_url')}",
    reports=REPORTS,
    queued=QUEUED,
)
STATE = "SELECT CAST(c_custkey AS STRING) AS page_name, CASE WHEN c_custkey % 5 > 0 THEN c_custkey END AS revision_id FROM {customer}"
SEEN = "SELECT CAST(c_custkey AS STRING) AS page_name, CASE WHEN c_custkey % 7 > 0 THEN c_custkey + c_custkey % 2 END AS revision_id FROM {customer}"
register("revision_change", C.revision_change, "SELECT page_name, s.revision_id, n.revision_id AS new_revision FROM state s JOIN seen n USING (page_name) WHERE s.revision_id IS NOT NULL AND n.revision_id IS DISTINCT FROM s.revision_id", state=STATE, seen=SEEN)
# A robots file for every host of pages; its parity and third digit decide over delays, groups and patterns.
_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
ROBOTS = f"""
SELECT host, pos, CASE pos WHEN 0 THEN '# comment' WHEN 1 THEN 'User-agent: *' WHEN 2 THEN 'Disallow: /en/' WHEN 3 THEN 'Crawl-delay: 2' WHEN 4 THEN 'Crawl-delay: soon' WHEN 5 THEN CASE WHEN length(host) % 2 = 0 THEN 'User-agent: Mill' ELSE 'User-agent: odd' END
  WHEN 6 THEN 'user-agent : other' WHEN 7 THEN 'Disallow: /' || substr(host, 1, 1) WHEN 8 THEN 'Allow: /de/  # pages' WHEN 9 THEN 'Disallow: /*?' WHEN 10 THEN 'Allow: /*.html$' WHEN 11 THEN 'Disallow:' WHEN 12 THEN 'Crawl-delay: ' || CAST(length(host) AS STRING)
  WHEN 13 THEN 'User-agent: millbot' WHEN 14 THEN CASE length(host) % 3 WHEN 0 THEN 'Disallow: /de/1' ELSE 'no rule' END WHEN 15 THEN 'Disallow: /fr/*7' ELSE '' END AS line
FROM (SELECT DISTINCT {_HOST} AS host FROM {{pages}}) h CROSS JOIN (SELECT n_nationkey AS pos FROM {{nation}}) n"""
_RULES = """
SELECT host, 1 AS g, ['*'] AS agents, false AS allow, '/en/' AS pattern, 2.0::DOUBLE AS delay FROM hosts
UNION ALL SELECT host, 2, CASE WHEN length(host) % 2 = 0 THEN ['mill', 'other'] ELSE ['odd', 'other'] END, a, CASE k WHEN 0 THEN '/' || substr(host, 1, 1) ELSE p END, length(host)::DOUBLE FROM hosts, (VALUES (0, false, ''), (1, true, '/de/'), (2, false, '/*?'), (3, true, '/*.html$')) v(k, a, p)
UNION ALL SELECT host, 3, ['millbot'], false, '/de/1', NULL FROM hosts WHERE length(host) % 3 = 0
UNION ALL SELECT host, 3, ['millbot'], false, '/fr/*7', NULL FROM hosts"""
_WITH = f"WITH hosts AS (SELECT DISTINCT host FROM lines), rules AS ({_RULES})"
register("robots_rules", R.robots_rules, f"{_WITH} SELECT host, g::BIGINT AS group_no, agents, allow, pattern, delay AS crawl_delay FROM rules", lines=ROBOTS)
register("crawl_delays", lambda lines: R.crawl_delays(R.rules_for(R.robots_rules(lines), "millbot")), f"{_WITH} SELECT host, max(delay) AS crawl_delay FROM rules WHERE list_contains(agents, 'mill') OR list_contains(agents, 'millbot') GROUP BY host HAVING max(delay) IS NOT NULL", lines=ROBOTS)
_REGEX = r"""'(?s)^' || replace(regexp_replace(regexp_replace(pattern, '\$$', ''), '([.^$+?()\[\]{}|\\])', '\\\1', 'g'), '*', '.*') || CASE WHEN pattern LIKE '%$' THEN '$' ELSE '' END"""
register(
    "url_policy", lambda urls, lines: R.url_policy(urls, R.rules_for(R.robots_rules(lines), "millbot")),
    rf"""{_WITH}, mine AS (SELECT host, allow, pattern, length(pattern) * 2 + allow::INT AS rank, {_REGEX} AS rx FROM rules WHERE list_contains(agents, 'mill') OR list_contains(agents, 'millbot'))
    SELECT id, url, coalesce((SELECT arg_max(allow, rank) FROM mine WHERE mine.host = t.host AND regexp_matches(t.target, mine.rx)), true) AS allowed
    FROM (SELECT *, {_HOST} AS host, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/') || regexp_extract(url, '^[^?#]*(\?[^#]+)', 1) AS target FROM urls) t""",
    urls="SELECT page_id AS id, url FROM {pages}", lines=ROBOTS,
)

# Item files: the key decides which one check fails.
_ID = _UUID.format("f", "p_partkey")
_NAME = "p_name || ' ' || CAST(p_partkey AS STRING)"
# The record as it must stand in its file; marks in it are replaced by what the key decides.
_MARKED = {k: None for k in Q.MEMBERS} | {
    "id": "@ID@", "name": "@NAME@", "wiki": {"page_id": "@PAGE@", "revision_id": None, "title": None, "url": "u"}, "template": "weapon", "category": "weapon", "equip_slots": [], "weight": "@WEIGHT@",
    "effects": [{"name": "Glow", "value": "@VALUE@", **dict.fromkeys(("value_kind", "bonus_type", "tooltip", "charges", "recharge_per_day", "note"))}], "customisation_hints": [], "flavor_text": "said \"é\" \\ or\tnot", "extraction_errors": {},
}
_K = "p_partkey % 29"
_MARKS = {
    "@ID@": f"CASE {_K} WHEN 11 THEN {_UUID.format('f', '(p_partkey - 1)')} ELSE {_ID} END",
    "@NAME@": _NAME,
    '"@PAGE@"': f"CASE {_K} WHEN 8 THEN ' ' ELSE '' END || CAST(p_partkey + CASE {_K} WHEN 9 THEN 1 ELSE 0 END AS STRING)",
    # The weight of every 13th part in 29 has another type, that of every 14th another form.
    '"@WEIGHT@"': f"CASE {_K} WHEN 13 THEN '\"heavy\"' WHEN 14 THEN '1.50' ELSE '1.5' END",
    '"@VALUE@"': f"CASE {_K} % 2 WHEN 0 THEN CAST({_K} AS STRING) ELSE CAST({_K} AS STRING) || '.5' END",
}


def _record_sql() -> str:
    text = json.dumps(_MARKED, indent=2, ensure_ascii=False).replace("\\", "' || chr(92) || '").replace("{", "{{").replace("}", "}}")
    for mark, sql in _MARKS.items():
        text = text.replace(mark, f"' || {sql} || '")
    body, end = text[: text.rindex("\n")], text[text.rindex("\n") :]
    return f"""'{body}' || CASE {_K} WHEN 12 THEN ',\n  "odd": 1' ELSE '' END || '{end}\n'"""


_PATH = f"""CASE {_K} WHEN 1 THEN 'odd/' || CAST(p_partkey AS STRING) || '.json' ELSE CASE {_K} WHEN 2 THEN 'Update-3' ELSE 'update-' || CAST(p_size + 1 AS STRING) END || '/' || CASE {_K} WHEN 3 THEN 'armor' ELSE 'weapon' END || '/' ||
    CASE {_K} WHEN 4 THEN {_UUID.format("g", "p_partkey")} WHEN 11 THEN {_UUID.format("f", "(p_partkey - 1)")} ELSE {_ID} END || '-' || CASE {_K} WHEN 5 THEN 'wrong' ELSE replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS STRING) END || '.json' END"""
_ODD = f"""CASE {_K} WHEN 6 THEN 'nothing' WHEN 7 THEN '{{{{"name":"x","id":"' || {_ID} || '"}}}}' ELSE {_record_sql()} END"""
FILES = f"SELECT {_PATH} AS path, {_ODD} AS record FROM {{part}}"
IDS = f"SELECT {_ID} AS id, CAST(p_partkey AS BIGINT) AS page_id FROM {{part}} WHERE p_partkey % 29 <> 10"
_FAILS = {
    "chk_path_shape": ("path_shape", "k = 1"),
    "chk_record": ("record", "k IN (6, 7, 12, 13)"),
    "chk_id_filename": ("id_filename", "k = 4"),
    "chk_canonical": ("canonical", "k IN (8, 14)"),
    "chk_registered": ("registered", "k IN (10, 11)"),
    "chk_page_id": ("page_id", "k = 9"),
    "chk_update_folder": ("update_folder", "k = 2"),
    "chk_category_folder": ("category_folder", "k = 3"),
    "chk_slug": ("slug", "k = 5"),
}


def _check(files, registry, name):
    return Q.item_file_checks(files, registry)[name]


for _name, (_check_name, _where) in _FAILS.items():
    # k is the part's key modulo 29, read back from the end of the path or from the name in it.
    register(
        _name,
        partial(_check, name=_name),
        f"SELECT '{_check_name}' AS check, path AS subject FROM (SELECT f.path, p.p_partkey % 29 AS k FROM (SELECT *, row_number() OVER () AS rn FROM files) f JOIN (SELECT *, row_number() OVER () AS rn FROM part) p USING (rn)) WHERE {_where}",
        dealt=True,
        files=FILES,
        registry=IDS,
    )
register("chk_one_file", lambda files, registry: Q.item_file_checks(files, registry)["chk_one_file"], f"SELECT 'one_file' AS check, regexp_extract(path, '{Q.PATH}', 3) AS subject FROM files WHERE regexp_matches(path, '{Q.PATH}') GROUP BY 2 HAVING count(*) > 1", dealt=True, files=FILES, registry=IDS)
register("chk_registry_ok", lambda lines: C.registry_defects(lines).groupBy("problem").agg(F.count("*").alias("n")), f"SELECT problem, count(*) AS n FROM ({_LINE_SQL}) WHERE problem IS NOT NULL GROUP BY problem", lines=LINES)

# Bundle checks.
EFFECTS = "SELECT replace(lower(s_name), '#', '-') AS key, CASE WHEN s_suppkey % 10 = 3 THEN '' ELSE s_name END AS name, CAST(s_suppkey % 60 AS STRING) AS dup FROM {supplier}"
USED = "SELECT l_orderkey AS item, 'supplier-' || lpad(CAST(l_suppkey + CASE WHEN l_partkey % 97 = 0 THEN 100000 ELSE 0 END AS STRING), 9, '0') AS effect, CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN 'odd' ELSE l_returnflag END AS bonus FROM {lineitem}"
BONUS = "SELECT DISTINCT l_returnflag AS key FROM {lineitem} WHERE l_returnflag <> 'R'"
register("val_effect_ref", lambda used, effects: Q.dangling(used, "effect", effects, "key", "effect_ref", "item"), "SELECT 'effect_ref' AS check, item::VARCHAR AS subject FROM used WHERE effect NOT IN (SELECT key FROM effects)", used=USED, effects=EFFECTS)
register("val_bonus_ref", lambda used, bonus: Q.dangling(used, "bonus", bonus, "key", "bonus_ref", "item"), "SELECT 'bonus_ref' AS check, item::VARCHAR AS subject FROM used WHERE used.bonus <> '' AND used.bonus NOT IN (SELECT key FROM bonus)", used=USED, bonus=BONUS)
register("val_unique", lambda effects: Q.duplicates(effects, "dup", "unique"), "SELECT 'unique' AS check, dup AS subject FROM effects GROUP BY dup HAVING count(*) > 1", effects=EFFECTS)
# Rows of all eight tables as JSON: the key modulo 7 decides over one defect.
_KEY = "'k_' || CAST(s_suppkey AS STRING)"
_ONE = "CASE s_suppkey % 7 WHEN {0} THEN '{1}' ELSE '{2}' END"
_ROWS = {
    "effects": f"""'{{{{"key":"' || {_KEY} || {_ONE.format(1, "-", "")} || '","name":' || {_ONE.format(2, '""', '"n"')} || {_ONE.format(3, ',"tooltip":1', ',"tooltip":null')} || {_ONE.format(4, ',"odd":1', "")} || '}}}}'""",
    "bonus_types": f"""'{{{{"key":"b"' || {_ONE.format(1, "", ',"name":"n"')} || {_ONE.format(2, ',"stacks_with_self":"x"', ',"stacks_with_self":true')} || '}}}}'""",
    "option_lists": f"""'{{{{"id":"o","options":[' || {_ONE.format(1, "", '{{"key":"a","name":"n","level":' + "' || " + _ONE.format(2, "1.5", "2") + " || '" + ',"value":0.5' + "' || " + _ONE.format(3, ',"odd":1', "") + " || '" + "}}")} || ']}}}}'""",
    "servers": f"""{_ONE.format(1, "[1]", '{{"key":"s","name":"n"}}')}""",
    "redirects": f"""'{{{{"from":"' || {_UUID.format("r", "s_suppkey")} || '"' || CASE s_suppkey % 7 WHEN 1 THEN '' WHEN 2 THEN ',"to":"x"' ELSE ',"to":null' END || '}}}}'""",
    "slot_compat": f"""'{{{{"colour_compat":{{{{"red":[' || {_ONE.format(1, "1", '"blue"')} || ']}}}},"kind_rules":[{{{{"kind":"k","category_in":["' || {_ONE.format(2, "hat", "armor")} || '"],"allow_options":[]}}}}]}}}}'""",
    "meta": f"""'{{{{"format_version":' || {_ONE.format(1, "0", "1")} || ',"catalog_version":"2026.01.02.0003","generated_at":"t","counts":{{{{"items":1,"effects":1,"bonus_types":1,"option_lists":1,"servers":1' || {_ONE.format(2, "", ',"redirects":-0')} || '}}}}}}}}'""",
    "items": f"""'{{{{"id":"' || {_UUID.format("i", "s_suppkey")} || '","name":"n","category":"c","effects":[{{{{"effect":"e","value":' || {_ONE.format(1, "true", "null")} || '}}}}]' || {_ONE.format(5, "", "}}")}""",
}
BUNDLE = " UNION ALL ".join(f"SELECT '{name}' AS table_name, s_suppkey AS subject, {sql} AS json FROM {{supplier}}" for name, sql in _ROWS.items())
_WRONG = [
    ("effects", 1, ".key: text"), ("effects", 2, ".name: text"), ("effects", 3, ".tooltip: type"), ("bonus_types", 1, ".name: missing"), ("bonus_types", 2, ".stacks_with_self: type"), ("option_lists", 1, ".options: too few"),
    ("option_lists", 2, ".options[].level: type"), ("servers", 1, ".: type"), ("redirects", 1, ".to: missing"), ("redirects", 2, ".to: text"), ("slot_compat", 1, ".colour_compat{}[]: type"), ("slot_compat", 2, ".kind_rules[].category_in[]: text"),
    ("meta", 1, ".format_version: minimum"), ("meta", 2, ".counts.redirects: missing"), ("items", 1, ".effects[].value: type"), ("items", 5, ".: json"),
]
_UNKNOWN = [("effects", 4, ".odd: unknown"), ("option_lists", 3, ".options[].odd: unknown")]
_expected = lambda rows: f"SELECT t AS table_name, s_suppkey AS subject, p AS problem FROM supplier, (VALUES {', '.join(map(str, rows))}) v(t, k, p) WHERE s_suppkey % 7 = k"
register("val_shape", shape_problems, _expected(_WRONG), rows=BUNDLE)
register("val_strict", lambda rows: shape_problems(rows, strict=True), _expected(_WRONG + _UNKNOWN), rows=BUNDLE)
register(
    "val_missing_file", lambda found: Q.missing_tables(found, ["items", "effects", "bonus_types", "option_lists", "servers", "redirects", "slot_compat", "meta"]),
    "SELECT name FROM (VALUES ('items'), ('effects'), ('bonus_types'), ('option_lists'), ('servers'), ('redirects'), ('slot_compat'), ('meta')) v(name) WHERE name NOT IN (SELECT name FROM found)",
    found="SELECT DISTINCT CASE s_suppkey % 4 WHEN 0 THEN 'items' WHEN 1 THEN 'effects' WHEN 2 THEN 'meta' ELSE 'servers' END AS name FROM {supplier}",
)
REDIRECTS = "SELECT o_orderkey * 2 AS source, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey * 20 END AS target FROM {orders}"
LIVE = "SELECT o_orderkey AS id FROM {orders} WHERE o_orderkey % 3 > 0"
register("val_redirect_live", lambda redirects, live: redirects.join(live, redirects["source"] == live["id"], "left_semi").select(F.lit("redirect_live").alias("check"), F.col("source").cast("string").alias("subject")), "SELECT 'redirect_live' AS check, source::VARCHAR AS subject FROM redirects WHERE source IN (SELECT id FROM live)", redirects=REDIRECTS, live=LIVE)
register("val_redirect_target", lambda redirects, live: Q.dangling(redirects, "target", live, "id", "redirect_target", "source"), "SELECT 'redirect_target' AS check, source::VARCHAR AS subject FROM redirects WHERE target IS NOT NULL AND target NOT IN (SELECT id FROM live)", redirects=REDIRECTS, live=LIVE)
CLAIMED = "SELECT 'part' AS table_name, count(*) AS claimed FROM {part} UNION ALL SELECT 'orders', count(*) + 1 FROM {orders} UNION ALL SELECT 'none', 0 FROM {region} WHERE r_regionkey = 0"
COUNTS = "SELECT 'part' AS table_name, count(*) AS n FROM {part} UNION ALL SELECT 'orders', count(*) FROM {orders}"
register("val_counts", Q.meta_counts, 'SELECT c.table_name, coalesce(k.n, 0) AS n, c.claimed FROM claimed c LEFT JOIN counts k ON c.table_name = k.table_name WHERE coalesce(k.n, 0) <> c.claimed', counts=COUNTS.replace("AS table", 'AS table'), claimed=CLAIMED)
