"""Queries of entry classification over texts built from parts: every rule is hit."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import entries as E
from .registry import register

_N = "CAST(p_size AS STRING)"
_TEXT = f"""CASE p_partkey % 23
  WHEN 0 THEN p_name || ' One of the following' WHEN 1 THEN 'Set of ' || p_type WHEN 2 THEN '2 Pieces Equipped: +5 Artifact bonus to ' || p_type
  WHEN 3 THEN 'Blue Augment Slot (empty)' WHEN 4 THEN 'Upgradeable - ' || p_name WHEN 5 THEN 'Mythic ' || p_type || ' Boost'
  WHEN 6 THEN p_name || ' — 3 Charges (Recharged/Day: ' || {_N} || ')' WHEN 7 THEN 'DR ' || {_N} || ' / Evil' WHEN 8 THEN 'Insight Guard (+' || {_N} || '%)'
  WHEN 9 THEN '+' || {_N} || '% Quality bonus to ' || p_name WHEN 10 THEN 'Rank : IV' WHEN 11 THEN '+' || {_N} || '.5 ' || p_name WHEN 12 THEN p_name || ' -' || {_N}
  WHEN 13 THEN 'Adds +' || {_N} || ' dice' WHEN 14 THEN p_name || ' ' || {_N} || '%' WHEN 15 THEN p_name || ' XX' WHEN 16 THEN p_name || ' VII' WHEN 17 THEN p_type || ' ' || {_N}
  WHEN 18 THEN 'Quiet' WHEN 19 THEN 'Odd 4x thing' WHEN 20 THEN 'Greater Calm' WHEN 21 THEN 'Superior Ease' ELSE p_name || ' +9 (Bug: off by ' || {_N} || ')' END"""
ENTRIES = f"""
SELECT CAST(p_partkey % 500 AS BIGINT) AS page_id, CAST(p_partkey AS BIGINT) AS entry_pos, {_TEXT} AS text,
  CASE WHEN p_partkey % 23 = 20 AND p_size % 2 = 0 THEN '+' || {_N} || ' Insight bonus to calm' WHEN p_partkey % 23 = 20 THEN '+3 attack and +2 damage' WHEN p_partkey % 23 = 21 THEN 'raised by ' || {_N} || '%'
    WHEN p_partkey % 23 = 12 THEN '-1 Luck bonus to x, +2 Insight bonus' END AS tooltip,
  CASE WHEN p_partkey % 23 IN (11, 13) THEN array('/page/Other', '/page/Luck_bonus') ELSE array() END AS hrefs,
  CASE WHEN p_partkey % 23 = 0 THEN array('a', p_type) ELSE array() END AS children,
  CASE WHEN p_partkey % 23 = 1 THEN array('2 Pieces Equipped: +' || {_N} || ' Profane bonus to x', 'none', '3 Piece Equipped: nothing') ELSE array() END AS tooltip_items
FROM {{part}}"""
# The same relation for DuckDB, whose array literals differ.
_DUCK = ENTRIES.replace("array()", "[]::VARCHAR[]")
for _literal in ("array('/page/Other', '/page/Luck_bonus')", "array('a', p_type)", f"array('2 Pieces Equipped: +' || {_N} || ' Profane bonus to x', 'none', '3 Piece Equipped: nothing')"):
    _DUCK = _DUCK.replace(_literal, "[" + _literal[6:-1] + "]")
_NOTE = E.NOTE
_SPLIT = f"""entries AS (SELECT page_id, entry_pos, tooltip, hrefs, children, tooltip_items,
  CASE WHEN regexp_matches(text, '{_NOTE}') THEN trim(regexp_extract(text, '{_NOTE}', 2)) END AS note,
  CASE WHEN regexp_matches(text, '{_NOTE}') THEN regexp_extract(text, '{_NOTE}', 1) ELSE text END AS text FROM raw)"""
_GUARDS = {"children": "len(children) > 0 AND ", "tooltip_items": r"len(list_filter(tooltip_items, lambda x: regexp_matches(x, '^\d+ Pieces? Equipped:'))) > 0 AND "}
_WHEN = " ".join(f"WHEN {_GUARDS.get(r.guard, '')}regexp_matches(text, '{r.pattern}') THEN '{r.id}'" for r in E.RULES)
_KIND = "CASE rule " + " ".join(f"WHEN '{r.id}' THEN '{r.kind}'" for r in E.RULES) + " END"
_VALUE_KIND = "CASE rule " + " ".join(f"WHEN '{r.id}' THEN '{r.value_kind}'" for r in E.RULES if r.value_kind) + " END"


def _capture(name: str) -> str:
    return "nullif(CASE rule " + " ".join(f"WHEN '{r.id}' THEN regexp_extract(text, '{r.pattern}', {r.captures.index(name) + 1})" for r in E.RULES if name in r.captures) + " END, '')"


_NAMES = sorted({c for r in E.RULES for c in r.captures})
_BASE = f"""WITH {_SPLIT}, matched AS (SELECT *, {_KIND} AS kind FROM (SELECT *, CASE {_WHEN} END AS rule FROM entries)),
captured AS (SELECT *, {", ".join(f"{_capture(n)} AS g_{n}" for n in _NAMES)} FROM matched)"""
_ROMAN = "CASE g_tier " + " ".join(f"WHEN '{k}' THEN {v}.0::DOUBLE" for k, v in E.ROMAN.items()) + " END"
_TIP = rf"len(regexp_extract_all(tooltip, '(\d+(?:\.\d+)?)', 1)) = 1 AND regexp_matches(tooltip, '{E.TOOLTIP_VALUE}')"


def _bonus(own: str, text: str | None, tiered: str) -> str:
    said = f"list_transform(regexp_extract_all(tooltip, '{E.TOOLTIP_BONUS}', 1), lambda x: lower(x))"
    parts = [f"lower({own})", f"lower(list_filter(list_transform(hrefs, lambda h: nullif(regexp_extract(h, '{E.LINK_BONUS}', 1), '')), lambda x: x IS NOT NULL)[1])"]
    parts += [f"lower(nullif(regexp_extract({text}, '{E.TEXT_BONUS}', 1), ''))"] * (text is not None)
    return f"coalesce({', '.join(parts)}, CASE WHEN NOT {tiered} OR len(list_distinct({said})) = 1 THEN {said}[1] END)"


_EFFECTS = rf"""SELECT page_id, entry_pos, rule, name, coalesce(v, CASE WHEN t THEN tv END) AS value, coalesce(contains(g_value, '.'), false) AS value_is_float,
  CASE WHEN v IS NOT NULL THEN CASE WHEN g_tier IS NOT NULL THEN 'tier' WHEN g_pct IS NOT NULL THEN 'percent' ELSE {_VALUE_KIND} END
       WHEN t THEN CASE WHEN regexp_extract(tooltip, '{E.TOOLTIP_VALUE}', 3) = '%' THEN 'percent' ELSE 'flat' END END AS value_kind,
  {_bonus("g_btype", None, "tiered")} AS bonus_type, g_charges::BIGINT AS charges, g_recharge::BIGINT AS recharge_per_day, note
FROM (SELECT *, v IS NULL AND tiered AND coalesce({_TIP}, false) AS t,
    CASE WHEN regexp_extract(tooltip, '{E.TOOLTIP_VALUE}', 1) = '-' THEN -1 ELSE 1 END * TRY_CAST(nullif(regexp_extract(tooltip, '{E.TOOLTIP_VALUE}', 2), '') AS DOUBLE) AS tv
  FROM (SELECT *, regexp_matches(name, '{E.TIERED}') AS tiered, coalesce({_ROMAN}, CASE WHEN g_sign = '-' THEN -1 ELSE 1 END * g_value::DOUBLE) AS v
    FROM (SELECT *, trim(regexp_replace(CASE WHEN rule = 'alignment_dr' THEN 'DR/' || g_bypass ELSE g_name END, '\s+', ' ', 'g')) AS name FROM captured WHERE kind = 'effect')))"""


def _query(name: str, run, sql: str) -> None:
    register(name, lambda raw: run(E.split_note(raw)), None, raw=ENTRIES)
    from .registry import ORACLES, TABLES

    ORACLES[name] = f"WITH raw AS ({_DUCK.format(**{t: t for t in TABLES})}), {_BASE[5:]} {sql}"


def _matched(run):
    return lambda rows: run(E.first_match(rows))


def _captured(run):
    return lambda rows: run(E.captures(E.first_match(rows)))


_query("bug_note_split", lambda rows: rows.select("page_id", "entry_pos", "text", "note"), "SELECT page_id, entry_pos, text, note FROM entries")
_query("first_match_rule", _matched(lambda m: m.select("page_id", "entry_pos", "rule", "kind")), "SELECT page_id, entry_pos, rule, kind FROM matched")
_query("guard_children", lambda rows: rows.where(E.has_children()).select("page_id", "entry_pos"), "SELECT page_id, entry_pos FROM entries WHERE len(children) > 0")
_query("guard_tooltip_items", lambda rows: rows.where(E.tooltip_items_match()).select("page_id", "entry_pos"), f"SELECT page_id, entry_pos FROM entries WHERE {_GUARDS['tooltip_items'][:-5]}")
for _rule, _key in zip(
    E.RULES,
    "rule_nested_system rule_set rule_set_bonus rule_augment_slot rule_augment_upgrade rule_mythic_reaper rule_charges rule_bypass rule_paren_percent rule_bonus_to rule_tier_colon rule_value_first rule_signed_suffix rule_adds rule_percent_suffix rule_roman_suffix rule_number_suffix rule_fallback".split(),
    strict=True,
):
    _columns = [f"g_{c}" for c in _rule.captures]

    def _of_rule(c, rule, columns):
        return c.where(F.col("rule") == rule).select("page_id", "entry_pos", *columns)

    _lowered = ", ".join(f"lower({c}) AS {c}" if c == "g_hint" else c for c in _columns)
    _query(_key, _captured(partial(_of_rule, rule=_rule.id, columns=_columns)), f"SELECT page_id, entry_pos, {_lowered} FROM captured WHERE rule = '{_rule.id}'")
_query("roman_value", _captured(lambda c: c.where("g_tier is not null").select("page_id", "entry_pos", E.roman_value(F.col("g_tier")).cast("double").alias("value"))), f"SELECT page_id, entry_pos, {_ROMAN} AS value FROM captured WHERE g_tier IS NOT NULL")
_query("effect_value", _captured(E.effects), _EFFECTS)
_query("bonus_type", _captured(lambda c: E.effects(c).groupBy("bonus_type").agg(F.count("*").alias("n"))), f"SELECT bonus_type, count(*) AS n FROM ({_EFFECTS}) GROUP BY 1")
_query("tiered_tooltip_value", _captured(lambda c: E.effects(c).where(F.col("name").rlike(E.TIERED)).select("page_id", "entry_pos", "value", "value_kind")), f"SELECT page_id, entry_pos, value, value_kind FROM ({_EFFECTS}) WHERE regexp_matches(name, '{E.TIERED}')")
_query("tiered_bonus_unanimous", _captured(lambda c: E.effects(c).where(F.col("name").rlike(E.TIERED)).select("page_id", "entry_pos", "bonus_type")), f"SELECT page_id, entry_pos, bonus_type FROM ({_EFFECTS}) WHERE regexp_matches(name, '{E.TIERED}')")
_HINT = "CASE rule " + " ".join(f"WHEN '{r.id}' THEN '{r.hint}'" for r in E.RULES if r.hint) + " ELSE lower(g_hint) END"
_query("hints", _captured(E.hints), f"SELECT page_id, entry_pos, {_HINT} AS hint_kind, text AS raw, g_name AS name, g_colour AS colour, g_text AS hint_text, children FROM captured WHERE kind = 'hint'")
_SETS = f"""SELECT page_id, entry_pos, item_pos, from_set, pieces, bonus_text, {_bonus("NULL", "bonus_text", "false")} AS bonus_type FROM (
  SELECT page_id, entry_pos, hrefs, tooltip, (i - 1)::INTEGER AS item_pos, true AS from_set, regexp_extract(item, '{E.ITEM}', 1)::BIGINT AS pieces, regexp_extract(item, '{E.ITEM}', 2) AS bonus_text
  FROM (SELECT *, unnest(tooltip_items) AS item, generate_subscripts(tooltip_items, 1) AS i FROM captured WHERE kind = 'set') WHERE regexp_matches(item, '{E.ITEM}')
  UNION ALL SELECT page_id, entry_pos, hrefs, tooltip, 0, false, g_pieces::BIGINT, g_text FROM captured WHERE kind = 'set_bonus')"""
_query("set_bonuses", _captured(E.set_bonuses), _SETS)
_query(
    "set_merge", _captured(E.set_merge),
    f"""SELECT page_id, n.name, coalesce(b.bonuses, []) AS bonuses FROM (SELECT page_id, arg_max(g_name, entry_pos) AS name FROM captured WHERE kind = 'set' GROUP BY page_id) n
    FULL JOIN (SELECT page_id, list(pieces::VARCHAR || '|' || bonus_text || '|' || coalesce(bonus_type, '-') ORDER BY NOT from_set, entry_pos, item_pos) AS bonuses FROM ({_SETS}) GROUP BY page_id) b USING (page_id)""",
)
_query("unclassified", _matched(E.unclassified), r"SELECT page_id, list(text ORDER BY entry_pos) AS texts FROM matched WHERE rule IS NULL OR (rule = 'plain_effect' AND regexp_matches(text, '\d')) GROUP BY page_id")
_query("rule_hits", _matched(E.rule_hits), "SELECT page_id, rule, count(*) AS n FROM matched WHERE rule IS NOT NULL GROUP BY ALL")
_query(
    "entry_warnings", _matched(E.entry_warnings),
    """SELECT page_id, 'note on ' || kind AS warning FROM matched WHERE note IS NOT NULL AND kind <> 'effect'
    UNION ALL SELECT page_id, 'set without a name' FROM matched GROUP BY page_id HAVING count(*) FILTER (kind = 'set') = 0 AND count(*) FILTER (kind = 'set_bonus') > 0""",
)
