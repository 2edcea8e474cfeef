"""Queries of the column functions and coercers over texts built from parts, orders and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce, text
from .registry import register

HOST = "wiki.example.org"
URLS = f"""
SELECT p_partkey AS id, CASE p_partkey % 9
  WHEN 0 THEN 'https://{HOST}/page/Item:' || replace(p_name, ' ', '_')
  WHEN 1 THEN 'https://{HOST}/page/Item:' || replace(p_name, ' ', '%20') || '%27s'
  WHEN 2 THEN 'http://other.example.org/page/' || p_type
  WHEN 3 THEN 'https://{HOST}/page/' || p_type || '?action=edit'
  WHEN 4 THEN 'https://{HOST}/page/Special:' || p_type
  WHEN 5 THEN 'https://{HOST}/api.php'
  WHEN 6 THEN 'http://{HOST}/page/Update_' || CAST(p_size AS STRING) || '_named_items'
  WHEN 7 THEN 'https://{HOST}/page/A+B_' || p_type
  ELSE 'https://{HOST}/page/' || replace(p_name, ' ', '_') || '#top' END AS url
FROM {{part}}"""
LISTINGS = """
SELECT p_partkey AS id, CASE p_partkey % 6
  WHEN 0 THEN 'Update_' || CAST(p_size AS STRING) || '_named_items'
  WHEN 1 THEN 'update_' || CAST(p_size AS STRING) || '_named_items'
  WHEN 2 THEN 'Update 0' || CAST(p_size AS STRING) || ' named items'
  WHEN 3 THEN 'Update_' || CAST(p_size AS STRING) || '_named_items_2'
  WHEN 4 THEN p_name ELSE NULL END AS name
FROM {part}"""
NAMES = """
SELECT p_partkey AS id, CASE p_partkey % 5
  WHEN 0 THEN '  ' || upper(p_name) || ' (' || p_brand || ') '
  WHEN 1 THEN p_name || '''s ' || p_type || ' of the long and winding road that leads to the very last door: '
  WHEN 2 THEN '***' WHEN 3 THEN NULL ELSE p_type || '  ' || p_name || ' : ' END AS name
FROM {part}"""
# Cells in the forms that coercers read, one form for each part.
CELLS = """
SELECT p_partkey AS id, CASE p_partkey % 24
  WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN 'Level -' || CAST(p_size AS STRING) || ' or so' WHEN 2 THEN '3.25 lbs' WHEN 3 THEN 'none'
  WHEN 4 THEN 'Yes' WHEN 5 THEN 'false' WHEN 6 THEN 'perhaps' WHEN 7 THEN '1,2' || CAST(p_size + 10 AS STRING) || ' pp 3 GP, 7cp'
  WHEN 8 THEN CAST(p_size AS STRING) || ' gp' WHEN 9 THEN 'Bound to Account on Acquire , Exclusive' WHEN 10 THEN 'Unbound' WHEN 11 THEN 'Bound to ' || p_brand || ', exclusive'
  WHEN 12 THEN '5.20[1d8+2] + ' || CAST(p_size AS STRING) || ' Pierce, Magic' WHEN 13 THEN '[2d6] - 1 Slash/Cold' WHEN 14 THEN '1d10 ' || p_type
  WHEN 15 THEN '19-20 / x' || CAST(p_size % 4 + 2 AS STRING) WHEN 16 THEN '20/3' WHEN 17 THEN 'Light: +' || CAST(p_size AS STRING) || ' Heavy: 9'
  WHEN 18 THEN 'Cloak / Back' WHEN 19 THEN 'N/A' WHEN 20 THEN '-' WHEN 21 THEN '' WHEN 22 THEN p_name ELSE NULL END AS cell
FROM {part}"""
PAGES_META = """
SELECT page_id AS id, '<script>X={"wgArticleId":' || CAST(page_id AS STRING) || ',"wgRevisionId":' || CAST(page_id * 3 AS STRING) || ',"wgCurRevisionId":' || CAST(page_id * 3 + 1 AS STRING)
  || ',"wgCategories":' || CASE page_id % 4 WHEN 0 THEN '["Named wands","' || CAST(page_id % 7 AS STRING) || ' things"]' WHEN 1 THEN '[]' WHEN 2 THEN '["a",3,null,"b"]' ELSE '["broken' END
  || '};</script>' || coalesce(html, '') AS html FROM {pages}"""
PAGES_META = PAGES_META.replace("X={", "X={{").replace("'};", "'}};")

_DECODED = "coalesce(try(url_decode(replace({0}, '+', '%2B'))), {0})"


def _one(name: str, relation: str, source: str, make, sql: str) -> None:
    """A query (id, value) of one column function."""
    register(name, lambda t: t.select("id", make(F.col(source)).alias("value")), f"SELECT id, {sql} AS value FROM t", t=relation)


_TITLE = f"nullif(regexp_extract(url, '^https?://{HOST.replace('.', '[.]')}/page/([^?#]*)(?:#.*)?$', 1), '')"
register(
    "page_title",
    lambda t: t.select("id", text.page_title(F.col("url"), HOST).alias("value")),
    f"""SELECT id, CASE WHEN x <> '' AND NOT starts_with(lower(x), 'special:') THEN x END AS value
    FROM (SELECT id, trim(replace(url_decode({_TITLE}), '_', ' ')) AS x FROM t)""",
    t=URLS,
)
_LAST = "list_last(string_split(url, '/page/'))"
_one("page_key", URLS, "url", text.page_key, f"replace(url_decode({_LAST}), ' ', '_')")
_one("url_title", URLS, "url", text.url_title, f"replace(url_decode({_LAST}), '_', ' ')")
_one("listing_url", LISTINGS, "name", lambda c: text.listing_url(c, f"https://{HOST}/page/"), f"'https://{HOST}/page/' || replace(name, ' ', '_')")
_one("update_number", LISTINGS, "name", text.update_number, r"TRY_CAST(nullif(regexp_extract(name, '^Update_(\d+)_named_items$', 1), '') AS INTEGER)")
_one(
    "update_slug", LISTINGS, "name", text.update_slug,
    r"coalesce('update-' || TRY_CAST(nullif(regexp_extract(name, '(?i)^Update[ _](\d+)[ _]named[ _]items$', 1), '') AS INTEGER)::VARCHAR, 'unknown')",
)
_one("file_slug", NAMES, "name", text.file_slug, "coalesce(nullif(trim(substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 60), '-'), ''), 'item')")
_one("slot_slug", NAMES, "name", text.slot_slug, "trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_')")
_one("cache_filename", NAMES, "name", text.cache_filename, "coalesce(nullif(substr(trim(regexp_replace(name, '[^A-Za-z0-9]+', '_', 'g'), '_'), 1, 80), ''), 'page') || '-' || substr(sha1(name), 1, 8) || '.html'")
_CLEAN = r"trim(regexp_replace(replace(name, chr(160), ' '), '\s+', ' ', 'g'))"
_one("clean_text", NAMES, "name", text.clean_text, _CLEAN)
_one("normalize_label", NAMES, "name", text.normalize_label, f"lower(rtrim(rtrim({_CLEAN}, ':')))")
_one("item_name_from_link", URLS, "url", lambda c: text.item_name(F.substring_index(c, "/page/", -1)), f"trim(replace(regexp_replace({_LAST}, '^Item:', ''), '_', ' '))")
_one("robots_token", NAMES, "name", text.robots_token, "lower(coalesce(nullif(regexp_extract(trim(name), '^([A-Za-z_-]+)', 1), ''), name))")
register(
    "category_folder",
    lambda t: t.groupBy(text.category_folder(F.lower("p_type")).alias("folder")).agg(F.count("*").alias("n")),
    "SELECT CASE WHEN lower(p_type) IN ('weapon', 'armor', 'shield', 'jewelry', 'clothing') THEN lower(p_type) ELSE 'other' END AS folder, count(*) AS n FROM t GROUP BY 1",
    t="SELECT CASE p_partkey % 3 WHEN 0 THEN 'Armor' WHEN 1 THEN 'jewelry' ELSE p_type END AS p_type FROM {part}",
)
_number = lambda key: f"""TRY_CAST(nullif(regexp_extract(html, '"{key}":(\\d+)', 1), '') AS BIGINT)"""
_HEADING = "trim(regexp_replace(nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), ''), '<[^>]*>', '', 'g'))"
register(
    "page_meta",
    lambda t: t.select("id", text.page_meta(F.col("html")).alias("m")).select("id", "m.*"),
    f"SELECT id, {_number('wgArticleId')} AS page_id, {_number('wgRevisionId')} AS revision_id, {_HEADING} AS title, trim(regexp_replace({_HEADING}, '^Item:', '')) AS name FROM t",
    t=PAGES_META,
)
_one("listing_revision", PAGES_META, "html", lambda c: text.page_number(c, "wgCurRevisionId"), _number("wgCurRevisionId"))
register(
    "page_categories",
    lambda t: t.select("id", text.page_categories(F.col("html")).alias("categories")),
    r"""SELECT id, coalesce(list_transform(list_filter(TRY_CAST(nullif(regexp_extract(html, '"wgCategories":(\[[^\]]*\])', 1), '') AS JSON)::JSON[], lambda v: json_type(v) = 'VARCHAR'), lambda v: v->>'$'), []) AS categories FROM t""",
    t=PAGES_META,
)

# Coercers.
_INT = r"TRY_CAST(nullif(regexp_extract({0}, '(-?\d+)', 1), '') AS BIGINT)"
_one("coerce_int", CELLS, "cell", coerce.to_int, _INT.format("cell"))
_one("coerce_float", CELLS, "cell", coerce.to_float, r"TRY_CAST(nullif(regexp_extract(cell, '(-?\d+(?:\.\d+)?)', 1), '') AS DOUBLE)")
_one("coerce_text", CELLS, "cell", coerce.to_text, "cell")
_one("coerce_first_segment", CELLS, "cell", coerce.first_segment, "trim(string_split(cell, ' / ')[1])")
_one("coerce_yes_no", CELLS, "cell", coerce.yes_no, "CASE WHEN lower(cell) IN ('yes', 'true') THEN true WHEN lower(cell) IN ('no', 'false') THEN false END")
_COINS = r"regexp_extract_all(cell, '(?i)([\d,]+)\s*(pp|gp|sp|cp)\b', {0})"
_one(
    "coerce_money", CELLS, "cell", coerce.to_copper,
    f"""CASE WHEN len({_COINS.format(1)}) > 0 THEN list_sum(list_transform(list_zip({_COINS.format(1)}, {_COINS.format(2)}),
      lambda p: replace(p[1], ',', '')::BIGINT * CASE lower(p[2]) WHEN 'pp' THEN 1000 WHEN 'gp' THEN 100 WHEN 'sp' THEN 10 ELSE 1 END))::BIGINT END""",
)
_BASE = r"lower(regexp_replace(cell, '(?i)\s*,\s*exclusive$', ''))"
_BOUND = f"""CASE {_BASE} WHEN 'bound to account on acquire' THEN 'account' WHEN 'bound to character on acquire' THEN 'character' WHEN 'bound to account on equip' THEN 'on_equip'
  WHEN 'bound to character on equip' THEN 'on_equip' WHEN 'unbound' THEN 'unbound' WHEN 'bound to account' THEN 'account' WHEN 'bound to character' THEN 'character' END"""
register(
    "coerce_binding",
    lambda t: t.select("id", coerce.binding(F.col("cell")).alias("b")).select("id", "b.*"),
    rf"SELECT id, {_BOUND} AS binding, CASE WHEN {_BOUND} IS NOT NULL THEN cell END AS binding_raw, regexp_matches(cell, '(?i)\s*,\s*exclusive$') AS exclusive FROM t",
    t=CELLS,
)
_D = r"'(?i)^(?:(?:(\d+(?:\.\d+)?)\s*)?\[\s*(\d+d\d+)\s*(?:([+-])\s*(\d+))?\s*\]|(\d+d\d+))\s*(?:([+-])\s*(\d+))?\s*(.*)$'"
_d = lambda k: f"nullif(regexp_extract(cell, {_D}, {k}), '')"
_s = lambda a, b: f"coalesce(CASE WHEN {_d(a)} = '-' THEN -1 ELSE 1 END * {_d(b)}::BIGINT, 0)"
register(
    "coerce_damage",
    lambda t: t.select("id", coerce.damage(F.col("cell")).alias("d")).where("d is not null").select("id", "d.*"),
    f"""SELECT id, coalesce({_d(1)}::DOUBLE, 1.0) AS multiplier, coalesce({_d(2)}, {_d(5)}) AS dice, {_s(3, 4)} AS bonus, {_s(6, 7)} AS enhancement,
      list_transform(list_filter(list_transform(regexp_split_to_array(regexp_extract(cell, {_D}, 8), '[,/]'), lambda x: trim(x)), lambda x: x <> ''),
        lambda x: CASE lower(x) WHEN 'slash' THEN 'Slashing' WHEN 'bludgeon' THEN 'Bludgeoning' WHEN 'pierce' THEN 'Piercing' WHEN 'magic' THEN 'Magic' WHEN 'force' THEN 'Force' ELSE x END) AS types
    FROM t WHERE regexp_matches(cell, {_D})""",
    t=CELLS,
)
_C = r"'(\d+(?:-\d+)?)\s*/\s*[xX×]?(\d+)'"
register(
    "coerce_crit",
    lambda t: t.select("id", coerce.crit(F.col("cell")).alias("c")).where("c is not null").select("id", F.col("c.range").alias("crit_range"), F.col("c.multiplier").alias("multiplier")),
    f"SELECT id, regexp_extract(cell, {_C}, 1) AS crit_range, regexp_extract(cell, {_C}, 2)::BIGINT AS multiplier FROM t WHERE regexp_matches(cell, {_C})",
    t=CELLS,
)
_V = r"regexp_extract_all(cell, '([A-Za-z][A-Za-z ]*?):\s*\+?(\d+)', {0})"
register(
    "coerce_armor_bonus",
    lambda t: t.select("id", coerce.armor_bonus(F.col("cell")).alias("a")).select(
        "id", F.col("a.bonus").alias("bonus"), F.transform("a.variants", lambda v: v["name"]).alias("names"), F.transform("a.variants", lambda v: v["value"]).alias("amounts")
    ),
    f"""SELECT id, CASE WHEN len({_V.format(1)}) = 0 THEN {_INT.format("cell")} END AS bonus,
      CASE WHEN len({_V.format(1)}) > 0 THEN list_transform({_V.format(1)}, lambda x: trim(x)) END AS names,
      CASE WHEN len({_V.format(1)}) > 0 THEN list_transform({_V.format(2)}, lambda x: x::BIGINT) END AS amounts FROM t""",
    t=CELLS,
)
register(
    "null_values",
    lambda t: t.where(coerce.is_null_text(F.col("cell"))).groupBy("cell").agg(F.count("*").alias("n")),
    "SELECT cell, count(*) AS n FROM t WHERE lower(cell) IN ('none', '', 'n/a', '-') GROUP BY cell",
    t=CELLS,
)
LOCATIONS = """
SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'Old Tower, end chest' WHEN 1 THEN p_name || ' + ' || p_type || ', reward' WHEN 2 THEN p_name || ', chest' ELSE p_brand END AS cell,
  CASE WHEN p_partkey % 4 = 1 THEN '/page/Item:' || p_type WHEN p_partkey % 4 = 2 THEN '/page/' || p_name END AS href,
  CASE WHEN p_partkey % 4 = 1 THEN p_type WHEN p_partkey % 4 = 2 THEN p_name END AS link, p_partkey % 4 = 2 AS in_bold
FROM {part}"""
_REST = r"nullif(trim(regexp_replace(trim(regexp_replace({0}, '[+,]\s*', ' ', 'g'), ' ,+'), '\s+', ' ', 'g')), '')"
register(
    "coerce_location",
    lambda t: t.select(
        "id",
        coerce.location(
            F.col("cell"),
            F.when(F.col("href").isNotNull(), F.array(F.struct("href", F.col("link").alias("text"), "in_bold"))),
        ).alias("s"),
    ).select("id", "s.*"),
    f"""SELECT id, CASE WHEN id % 4 = 1 THEN []::VARCHAR[] WHEN id % 4 = 2 THEN [link] ELSE [trim(string_split(cell, ',')[1])] END AS quests,
      CASE WHEN id % 4 = 1 THEN [link] ELSE []::VARCHAR[] END AS crafted_from,
      {_REST.format("replace(cell, coalesce(link, trim(string_split(cell, ',')[1])), '')")} AS detail, cell AS raw FROM t""",
    t=LOCATIONS,
)
