"""Queries of the parse job, row mapping and templates: parts wrapped as pages must give back what they were made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import infobox as I
from ..operators import items
from ..operators.ledger import first_by, list_listings, list_or_seed, with_number
from .registry import register
from .text_queries import HOST

_N = "CAST(p_size AS STRING)"
_BOX = f"""'<table><tr><th>Proficiency Class</th><td>' || p_type || '</td></tr><tr><th>Minimum&nbsp;Level : </th><td>' || {_N} || '</td></tr><tr><th>Base Value</th><td><span class="sortkey">0007</span> ' || {_N} || ' gp</td></tr>'
  || '<tr><th>Location</th><td><b><a href="/page/Q">' || p_name || '</a></b>, end chest</td></tr><tr><th>Rarity</th><td>none</td></tr><tr><td>no head</td></tr><tr><th>Odd row</th><td>x ' || p_brand || '</td></tr>'
  || '<tr><th>Enchantments</th><td><ul><li>Glow +' || {_N} || '<span class="tooltip">+4 Insight bonus</span></li><li>Quiet <a href="/page/Luck_bonus">' || p_type || '</a><ul><li>inner</li></ul></li><li> </li></ul></td></tr></table>'"""
WRAPPED = f"""
SELECT CAST(p_partkey AS BIGINT) AS page_id, '<html><head><script>X={{{{"wgCategories":["' || CASE p_partkey % 10 WHEN 9 THEN 'Raw ingredients' ELSE 'Named wands' END || '"]}}}};</script></head><body><h1 id="firstHeading">Item:' || p_name || '</h1><table><tr><th>a</th><td>outside</td></tr></table><div class="mw-parser-output">'
  || CASE WHEN p_partkey % 10 < 8 THEN '<table><tr><th>small</th><td>one</td></tr></table>' || {_BOX} ELSE '<p>No table &amp; nothing.</p>' END || '</div></body></html>' AS html
FROM {{part}}"""
PARTS = "SELECT CAST(p_partkey AS BIGINT) AS page_id, p_name, p_type, p_brand, CAST(p_size AS STRING) AS n FROM {part} WHERE p_partkey % 10 < 8"
LINKED = "SELECT page_id, replace(html, 'href=\"/', 'href=\"/page/') AS html FROM {pages}"
_HREFS = "(SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), 1) - 1 AS pos FROM pages_in)"
_DECODE = "url_decode(substr(href, 7))"
register(
    "page_links",
    lambda pages_in: I.page_links(I.parse_pages(pages_in), HOST).select("page_id", "pos", "title", "url"),
    f"SELECT page_id, pos::INTEGER AS pos, replace({_DECODE}, '_', ' ') AS title, 'https://{HOST}' || href AS url FROM {_HREFS}",
    pages_in=LINKED,
)
register(
    "listing_item_links",
    lambda pages_in: first_by(I.page_links(I.parse_pages(pages_in), HOST), ["page_id", "url"], "pos").select("page_id", "pos", "title"),
    f"SELECT page_id, min(pos)::INTEGER AS pos, replace({_DECODE}, '_', ' ') AS title FROM {_HREFS} GROUP BY page_id, href",
    pages_in=LINKED,
)
INDEX = "SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN 'Update_' || CAST(page_id % 40 AS STRING) || '_named_items' ELSE url END AS page_name FROM {pages}"
register(
    "listing_pages",
    lambda index: list_listings(index.select("page_name").distinct()).where("n is not null").select("page_name", "n"),
    r"SELECT DISTINCT page_name, regexp_extract(page_name, '^Update_(\d+)_named_items$', 1)::INTEGER AS n FROM index_rows WHERE regexp_matches(page_name, '^Update_\d+_named_items$')".replace("index_rows", "index"),
    index=INDEX,
)
SEED = "SELECT 'Update_' || CAST(n_nationkey AS STRING) || '_named_items' AS page_name FROM {nation}"


register(
    "seed_fallback",
    lambda index, seed: list_or_seed(with_number(index, "page_name").where("n > 1000").select("page_name"), seed),
    r"SELECT page_name FROM seed WHERE NOT EXISTS (FROM index WHERE TRY_CAST(nullif(regexp_extract(page_name, '^Update_(\d+)_named_items$', 1), '') AS INTEGER) > 1000)",
    index=INDEX, seed=SEED,
)

_CELLS = """(SELECT page_id, 0 AS a, 0 AS b, 'small' AS label, 'one' AS text FROM parts UNION ALL SELECT page_id, 1, 0, 'Proficiency Class', p_type FROM parts UNION ALL SELECT page_id, 1, 1, 'Minimum' || chr(160) || 'Level :', n FROM parts
  UNION ALL SELECT page_id, 1, 2, 'Base Value', n || ' gp' FROM parts UNION ALL SELECT page_id, 1, 3, 'Location', p_name || ' , end chest' FROM parts UNION ALL SELECT page_id, 1, 4, 'Rarity', 'none' FROM parts
  UNION ALL SELECT page_id, 1, 6, 'Odd row', 'x ' || p_brand FROM parts UNION ALL SELECT page_id, 1, 7, 'Enchantments', 'Glow +' || n || ' Quiet ' || p_type || ' inner' FROM parts)"""
_cells = lambda wrapped: I.parse_pages(wrapped).where("kind = 'cell'")
register("infobox_rows", lambda wrapped, parts: _cells(wrapped).select("page_id", "a", "b", "label"), f"SELECT page_id, a, b, label FROM {_CELLS}", wrapped=WRAPPED, parts=PARTS)
register("cell_text", lambda wrapped, parts: _cells(wrapped).where("label <> 'Location'").select("page_id", "a", "b", "text"), f"SELECT page_id, a, b, text FROM {_CELLS} WHERE label <> 'Location'", wrapped=WRAPPED, parts=PARTS)
register(
    "infobox_candidates", lambda wrapped, parts: _cells(wrapped).groupBy("page_id", "a").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("label")).alias("labels")),
    f"SELECT page_id, a, count(*) AS n, list_sort(list_distinct(list(label))) AS labels FROM {_CELLS} GROUP BY ALL",
    wrapped=WRAPPED, parts=PARTS,
)
register("infobox_pick", lambda wrapped, parts: I.pick_infobox(_cells(wrapped)).select("page_id", "a", "score").distinct(), "SELECT page_id, 1 AS a, 107::BIGINT AS score FROM parts", wrapped=WRAPPED, parts=PARTS)
register("effects_cell", lambda wrapped, parts: first_by(_cells(wrapped).where(F.lower("label").isin(*I.EFFECT_LABELS)), ["page_id"], "b").select("page_id", "b"), "SELECT page_id, 7 AS b FROM parts", wrapped=WRAPPED, parts=PARTS)
register(
    "effect_entries",
    lambda wrapped, parts: I.parse_pages(wrapped).where("kind = 'entry'").select("page_id", "text", "tooltip", "hrefs", "children"),
    "SELECT page_id, 'Glow +' || n AS text, '+4 Insight bonus' AS tooltip, []::VARCHAR[] AS hrefs, []::VARCHAR[] AS children FROM parts UNION ALL SELECT page_id, 'Quiet ' || p_type, NULL, ['/page/Luck_bonus'], ['inner'] FROM parts",
    wrapped=WRAPPED, parts=PARTS,
)
register(
    "location_links",
    lambda wrapped, parts: I.cell_links(I.parse_pages(wrapped)).where("label = 'Location'").select("page_id", F.inline("links")).select("page_id", "href", F.col("text").alias("link"), "in_bold"),
    "SELECT page_id, '/page/Q' AS href, p_name AS link, true AS in_bold FROM parts",
    wrapped=WRAPPED, parts=PARTS,
)
register(
    "page_outcome", lambda wrapped: I.page_outcome(wrapped, I.pick_infobox(_cells(wrapped))),
    "SELECT page_id, CASE WHEN page_id % 10 < 8 THEN 'extracted' WHEN page_id % 10 = 9 THEN 'skipped' ELSE 'failed' END AS outcome FROM wrapped",
    wrapped=WRAPPED,
)

# Row mapping over the unpivoted columns of parts.
CELLS = """
SELECT CAST(p_partkey AS BIGINT) AS page_id, 0 AS row_pos, CASE p_partkey % 5 WHEN 0 THEN 'Proficiency Class' WHEN 1 THEN ' Armor  Type: ' WHEN 2 THEN 'Shield type' WHEN 3 THEN 'Item Type' ELSE 'Material' END AS label, p_type AS text FROM {part}
UNION ALL SELECT CAST(p_partkey AS BIGINT), 1, 'Minimum Level:', CASE p_partkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'high' ELSE CAST(p_size AS STRING) END FROM {part}
UNION ALL SELECT CAST(p_partkey AS BIGINT), 2, 'Base Value', CAST(p_size AS STRING) || ' gp' FROM {part}
UNION ALL SELECT CAST(p_partkey AS BIGINT), 3, 'min level', CASE WHEN p_partkey % 3 = 0 THEN 'unclear' ELSE CAST(p_size + 1 AS STRING) END FROM {part}
UNION ALL SELECT CAST(p_partkey AS BIGINT), 4, CASE p_partkey % 3 WHEN 0 THEN 'Rarity' WHEN 1 THEN p_brand ELSE 'F:x shown.png' END, p_name FROM {part}"""
_LABEL = r"lower(rtrim(rtrim(trim(regexp_replace(label, '\s+', ' ', 'g')), ':')))"
_TARGET = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in I.FIELDS.items()) + " END"
_IGNORED = f"(label IN ({', '.join(repr(x) for x in I.IGNORED)}) OR regexp_matches(label, '{I.IGNORED_PATTERN}'))"
_MAPPED = f"WITH named AS (SELECT page_id, row_pos, {_LABEL} AS label, text FROM cells), mapped AS (SELECT *, {_TARGET} AS target, {_IGNORED} AS ignored, lower(text) IN ('none', '', 'n/a', '-') AS is_null FROM named)"
register("map_rows", lambda cells: I.map_rows(cells).select("page_id", "row_pos", "label", "target", "ignored", "is_null"), f"{_MAPPED} SELECT page_id, row_pos, label, target, ignored, is_null FROM mapped", cells=CELLS)
register("ignored_rows", lambda cells: I.map_rows(cells).where("ignored").groupBy("label").agg(F.count("*").alias("n")), f"{_MAPPED} SELECT label, count(*) AS n FROM mapped WHERE ignored GROUP BY label", cells=CELLS)
register("unmapped_rows", lambda cells: I.unmapped(I.map_rows(cells)), f"{_MAPPED} SELECT page_id, label, arg_max(text, row_pos) AS text FROM mapped WHERE target IS NULL AND NOT ignored GROUP BY ALL", cells=CELLS)
_LEVEL = r"regexp_extract(text, '(-?\d+)', 1)"
register(
    "pivot_fields",
    lambda cells: I.pivot_fields(I.coerced(I.map_rows(cells)), ("minimum_level", "base_value_cp")).select(
        "page_id", F.get_json_object("minimum_level", "$.v").cast("bigint").alias("minimum_level"), F.get_json_object("base_value_cp", "$.v").cast("bigint").alias("base_value_cp")
    ),
    f"""{_MAPPED} SELECT page_id, arg_max({_LEVEL}::BIGINT, row_pos) FILTER (target = 'minimum_level' AND NOT is_null AND {_LEVEL} <> '') AS minimum_level,
      max(CASE WHEN target = 'base_value_cp' THEN {_LEVEL}::BIGINT * 100 END) AS base_value_cp FROM mapped GROUP BY page_id""".replace("arg_max(" + _LEVEL + "::BIGINT", "arg_max(TRY_CAST(" + _LEVEL + " AS BIGINT)").replace("THEN " + _LEVEL + "::BIGINT", "THEN TRY_CAST(" + _LEVEL + " AS BIGINT)"),
    cells=CELLS,
)
register(
    "extraction_errors",
    lambda cells: I.extraction_errors(I.coerced(I.map_rows(cells))).select("page_id", F.explode("errors").alias("target", "text")),
    f"{_MAPPED} SELECT page_id, target, arg_max(text, row_pos) AS text FROM mapped WHERE target = 'minimum_level' AND NOT is_null AND {_LEVEL} = '' GROUP BY ALL",
    cells=CELLS,
)
register(
    "detect_template", lambda cells: I.detect_template(I.map_rows(cells)),
    "SELECT DISTINCT page_id, CASE page_id % 5 WHEN 0 THEN 'weapon' WHEN 1 THEN 'armor' WHEN 2 THEN 'shield' WHEN 3 THEN 'accessory' ELSE 'accessory_untyped' END AS template FROM cells",
    cells=CELLS,
)
DERIVED = """
SELECT CAST(p_partkey AS BIGINT) AS page_id, CASE p_partkey % 5 WHEN 0 THEN 'weapon' WHEN 1 THEN 'armor' WHEN 2 THEN 'shield' WHEN 3 THEN 'accessory' ELSE 'accessory_untyped' END AS template,
  CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'Jewelry / ' || p_type ELSE p_type || ' / Belt' END AS item_type, p_type || ', Ring  or Left Hand,' AS slot,
  p_name AS weapon_type, p_brand AS armor_type, p_type AS shield_type, CASE WHEN p_partkey % 3 = 0 THEN 'Rune Arms' ELSE 'Other' END AS category_in FROM {part}"""
_derived = lambda rows: I.derive(rows.withColumn("categories", F.array("category_in")))
register(
    "derive_category", lambda rows: _derived(rows).select("page_id", "category"),
    "SELECT page_id, CASE WHEN template IN ('weapon', 'armor', 'shield') THEN template WHEN template = 'accessory' AND item_type LIKE 'Jewelry / %' THEN 'jewelry' ELSE 'other' END AS category FROM rows",
    rows=DERIVED,
)
register(
    "derive_item_type", lambda rows: _derived(rows).select("page_id", "derived_type"),
    """SELECT page_id, CASE template WHEN 'weapon' THEN weapon_type WHEN 'armor' THEN armor_type WHEN 'shield' THEN shield_type WHEN 'accessory' THEN string_split(item_type, ' / ')[2]
      ELSE coalesce(item_type, CASE WHEN category_in = 'Rune Arms' THEN 'Rune Arm' END) END AS derived_type FROM rows""",
    rows=DERIVED,
)
register(
    "derive_slots", lambda rows: _derived(rows).select("page_id", "equip_slots"),
    """SELECT page_id, CASE template WHEN 'weapon' THEN ['main_hand'] WHEN 'armor' THEN ['body'] WHEN 'shield' THEN ['off_hand'] WHEN 'accessory' THEN [lower(shield_type), 'ring', 'left_hand'] ELSE [] END AS equip_slots FROM rows""",
    rows=DERIVED,
)


# Pages with a row for most fields; the key decides over the kind and what cannot be read.
_ROW = "'<tr><th>{0}</th><td>' || {1} || '</td></tr>'"
_KIND = "CASE p_partkey % 4 WHEN 0 THEN 'Proficiency Class' WHEN 1 THEN 'Armor Type' WHEN 2 THEN 'Shield Type' ELSE 'Item Type' END"
_FULL = [
    ("Minimum Level", _N), ("Required Race", "'r ' || p_brand"), ("Binding", "CASE p_partkey % 3 WHEN 0 THEN 'Bound to Account on Acquire, Exclusive' WHEN 1 THEN 'Unbound' ELSE 'Odd' END"),
    ("Material", "p_brand"), ("Hardness", "CASE p_partkey % 5 WHEN 0 THEN 'soft' ELSE '7' END"), ("Base Value", f"{_N} || ' gp, 1,005 cp'"), ("Weight", f"{_N} || '.5 lbs'"), ("Accepts Sentience?", "'Yes'"),
    ("Damage and Type", "'1.5[2d6 + 3] +2 Slash, Cold'"), ("Critical threat range", "'19-20 / x2'"), ("Weapon type", "'Club / Simple'"), ("Armor Bonus", "'Light: +3 Heavy: 5'"), ("Shield Bonus", "'None'"), ("Equips To", "'Ring, Neck or Left Hand'"),
    ("Location", "'<b><a href=\"/page/Q\">' || p_name || '</a></b>, end chest + <a href=\"/page/Item:X\">Ore</a>'"), ("Notes", "'n ' || p_name"),
]
ITEM_PAGES = f"""
SELECT CAST(p_partkey AS BIGINT) AS page_id, '/page/Item:' || CAST(p_partkey AS STRING) AS url, '<html><head><script>X={{{{"wgArticleId":' || CAST(p_partkey + 7 AS STRING) || ',"wgRevisionId":' || {_N} || ',"wgCategories":["Rune Arms"]}}}};</script></head><body><h1>Item:' || p_name || '</h1><div class="mw-parser-output"><table><tr><th>small</th><td><ul><li>Lost +9</li></ul></td></tr></table><table><tr><th>' || {_KIND} || '</th><td>' || CASE p_partkey % 4 WHEN 3 THEN 'Jewelry / ' ELSE '' END || p_type || '</td></tr>'
  || {" || ".join(_ROW.format(*x) for x in _FULL)}
  || '<tr><th>Enchantments</th><td><ul><li>Glow +' || {_N} || ' (Bug: odd)<span class="tooltip">+4 Insight bonus</span></li><li>Red Augment Slot</li><li>2 Pieces Equipped: ' || p_type || '</li><li>Haste &mdash; 3 Charges</li></ul></td></tr></table></div></body></html>' AS html
FROM {{part}} WHERE p_partkey % 10 < 8"""


def flat_items(pages):
    """Items with their nested fields as columns."""
    rows = items.extract_items(pages)
    stats = [F.col(f"{g}.{m}").alias(f"{g}_{m}") for g in ("weapon_stats", "armor_stats", "shield_stats", "wiki", "source") for m in rows.schema[g].dataType.names if m != "armor_bonus_variants"]
    plain = [c for c in rows.columns if c not in ("weapon_stats", "armor_stats", "shield_stats", "wiki", "source", "effects", "customisation_hints", "named_set", "extraction_errors")]
    said = lambda c, *names: F.transform(c, lambda x: F.concat_ws("|", *[F.coalesce(x[n].cast("string"), F.lit("-")) for n in names])).alias(c)
    whole = F.transform("effects", lambda x: F.concat_ws("|", x["name"], F.coalesce(x["value"].cast("bigint").cast("string"), F.lit("-")), *[F.coalesce(x[n].cast("string"), F.lit("-")) for n in ("value_kind", "bonus_type", "tooltip", "charges", "note")]))
    return rows.select(
        *plain, *stats, F.transform("armor_stats.armor_bonus_variants", lambda v: F.concat_ws(":", v["name"], v["value"].cast("string"))).alias("armor_stats_variants"), whole.alias("effects"),
        said("customisation_hints", "kind", "raw", "colour"), F.transform("named_set.bonuses", lambda b: F.concat_ws("|", b["pieces"].cast("string"), b["text"])).alias("set_bonuses"), F.col("named_set.name").alias("set_name"),
        F.array_sort(F.transform(F.map_entries("extraction_errors"), lambda e: F.concat_ws("|", e["key"], e["value"]))).alias("errors"),
    )


_MINTED = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
register(
    "extract_items", flat_items,
    f"""SELECT k AS page_key, {_MINTED} AS id, p_name AS name, ['weapon', 'armor', 'shield', 'accessory'][k % 4 + 1] AS template, ['weapon', 'armor', 'shield', 'jewelry'][k % 4 + 1] AS category,
      CASE k % 4 WHEN 0 THEN 'Club' ELSE p_type END AS item_type, CASE k % 4 WHEN 0 THEN ['main_hand'] WHEN 1 THEN ['body'] WHEN 2 THEN ['off_hand'] ELSE ['ring', 'neck', 'left_hand'] END AS equip_slots,
      p_size::BIGINT AS minimum_level, 'r ' || p_brand AS required_race, NULL::VARCHAR AS excluded_race, NULL::VARCHAR AS required_class, NULL::VARCHAR AS required_feat, NULL::VARCHAR AS required_trait,
      CASE k % 3 WHEN 0 THEN 'account' WHEN 1 THEN 'unbound' END AS binding, CASE k % 3 WHEN 0 THEN 'Bound to Account on Acquire, Exclusive' WHEN 1 THEN 'Unbound' END AS binding_raw, k % 3 = 0 AS exclusive,
      p_brand AS material, CASE WHEN k % 5 > 0 THEN 7::BIGINT END AS hardness, NULL::BIGINT AS durability, (p_size * 100 + 1005)::BIGINT AS base_value_cp, p_size + 0.5::DOUBLE AS weight, NULL::VARCHAR AS upgradeable, true AS accepts_sentience, NULL::VARCHAR AS umd_dc, NULL::VARCHAR AS umd_exempt_classes,
      NULL::VARCHAR AS flavor_text, 'n ' || p_name AS notes, NULL::VARCHAR AS tips,
      CASE WHEN k % 4 = 0 THEN p_type END AS weapon_stats_proficiency, 'Club' AS weapon_stats_weapon_type, NULL::VARCHAR AS weapon_stats_handedness, 1.5::DOUBLE AS weapon_stats_damage_multiplier, '2d6' AS weapon_stats_damage_dice, 3::BIGINT AS weapon_stats_damage_bonus, 2::BIGINT AS weapon_stats_enhancement_bonus,
      ['Slashing', 'Cold'] AS weapon_stats_damage_types, '19-20' AS weapon_stats_critical_range, 2::BIGINT AS weapon_stats_critical_multiplier, NULL::VARCHAR AS weapon_stats_attack_mod, NULL::VARCHAR AS weapon_stats_damage_mod,
      CASE WHEN k % 4 = 1 THEN p_type END AS armor_stats_armor_type, NULL::BIGINT AS armor_stats_armor_bonus, NULL::BIGINT AS armor_stats_max_dex_bonus, NULL::BIGINT AS armor_stats_armor_check_penalty, NULL::BIGINT AS armor_stats_arcane_spell_failure,
      CASE WHEN k % 4 = 2 THEN p_type END AS shield_stats_shield_type, NULL::BIGINT AS shield_stats_shield_bonus, NULL::BIGINT AS shield_stats_damage_reduction,
      k + 7 AS wiki_page_id, p_size::BIGINT AS wiki_revision_id, 'Item:' || p_name AS wiki_title, url AS wiki_url, [p_name] AS source_quests, 'end chest' AS source_detail, ['Ore'] AS source_crafted_from, p_name || ' , end chest + Ore' AS source_raw,
      ['Light:3', 'Heavy:5'] AS armor_stats_variants, ['Glow|' || p_size || '|flat|insight|+4 Insight bonus|-|Bug: odd', 'Haste|-|-|-|-|3|-'] AS effects, ['augment_slot|Red Augment Slot|Red'] AS customisation_hints, ['2|' || p_type] AS set_bonuses, NULL::VARCHAR AS set_name,
      list_sort(list_filter([CASE WHEN k % 3 = 2 THEN 'binding|Odd' END, CASE WHEN k % 5 = 0 THEN 'hardness|soft' END], lambda x: x IS NOT NULL)) AS errors
    FROM (SELECT *, p_partkey::BIGINT AS k, md5('catalog|' || (p_partkey + 7)::VARCHAR) AS h, '/page/Item:' || p_partkey::VARCHAR AS url FROM part WHERE p_partkey % 10 < 8)""",
    pages=ITEM_PAGES,
    dealt=True,
)
