"""Queries of the bundle validator: nested items, tables and meta counts with planted faults, and the gate before references."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import bundle as B
from .catalog_queries import _UUID
from .registry import register

_ITEM = _UUID.format("item", "o_orderkey")
_TEXT = lambda x: f"CAST({x} AS STRING)"
# An item an order: the keys decide over effects, bonus types, slots and constraints that are unknown, repeated or upside down.
NESTED = f"""
SELECT 'items' AS table_name, {_TEXT("o_orderkey")} AS subject, '{{{{"id":"' || {_ITEM} || '","name":"n","category":"weapon","effects":[{{{{"effect":"e_' || {_TEXT("o_custkey % 40")} || '","bonus_type":'
  || CASE o_orderkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '""' ELSE '"b_' || {_TEXT("o_custkey % 6")} || '"' END || '}}}}],"customisation_slots":[{{{{"id":"s0","kind":"k","min":' || {_TEXT("o_custkey % 3")} || ',"max":' || {_TEXT("o_orderkey % 4")}
  || ',"options":{{{{' || CASE o_orderkey % 3 WHEN 0 THEN '' ELSE '"shared":"list_' || {_TEXT("o_custkey % 6")} || '"' END || '}}}}}}}},{{{{"id":"s' || {_TEXT("o_orderkey % 3")} || '","kind":"k","min":2,"max":1,"colour":"c_' || {_TEXT("o_custkey % 5")}
  || '"}}}}],"constraints":[{{{{"type":"requires","if_slot":"s0","then_slot":"s' || {_TEXT("o_custkey % 3")} || '"}}}},{{{{"type":"max_selected","slots":["s0","s' || {_TEXT("o_orderkey % 4")} || '"],"count":1}}}}]}}}}' AS json FROM {{orders}}
UNION ALL SELECT 'effects', 'e', '{{{{"key":"e_' || {_TEXT("k")} || '","name":"n"}}}}' FROM (SELECT DISTINCT CASE o_custkey % 40 WHEN 8 THEN 9 ELSE o_custkey % 40 END AS k, CASE o_custkey % 40 WHEN 8 THEN 1 ELSE 0 END AS again FROM {{orders}}) x WHERE k <> 7
UNION ALL SELECT 'bonus_types', 'b', '{{{{"key":"b_' || {_TEXT("k")} || '","name":"n"}}}}' FROM (SELECT DISTINCT o_custkey % 6 AS k FROM {{orders}}) x WHERE k <> 2
UNION ALL SELECT 'option_lists', 'l', '{{{{"id":"list_' || {_TEXT("n_nationkey")} || '","options":[{{{{"key":"a","name":"n"}}}}]}}}}' FROM {{nation}} WHERE n_nationkey < 5
UNION ALL SELECT 'servers', 's', '{{{{"key":"s","name":"n"}}}}' FROM {{region}}
UNION ALL SELECT 'slot_compat', 'slot_compat', '{{{{"colour_compat":{{{{"c_0":[],"c_1":["c_0"],"c_2":[],"c_3":[]}}}},"kind_rules":[]}}}}' FROM {{region}} WHERE r_regionkey = 0
UNION ALL SELECT 'redirects', {_TEXT("o_orderkey")}, '{{{{"from":"' || CASE o_orderkey % 11 WHEN 0 THEN {_ITEM} ELSE {_UUID.format("gone", "o_orderkey")} END || '","to":' || CASE o_orderkey % 7 WHEN 0 THEN 'null' WHEN 1 THEN '"' || {_UUID.format("lost", "o_orderkey")} || '"' ELSE '"' || {_ITEM} || '"' END || '}}}}' FROM {{orders}}
UNION ALL SELECT 'meta', 'meta', '{{{{"format_version":1,"catalog_version":"2026.01.02.0003","generated_at":"t","counts":{{{{"items":' || {_TEXT("count(*)")} || ',"effects":39,"bonus_types":5,"option_lists":9,"servers":5,"redirects":' || {_TEXT("count(*) + 1")} || '}}}}}}}}' FROM {{orders}}"""
_O = "FROM orders"
_WRONG = {
    "effect_ref": f"SELECT o_orderkey::VARCHAR, 'unknown effect e_7' {_O} WHERE o_custkey % 40 = 7 UNION ALL SELECT o_orderkey::VARCHAR, 'unknown effect e_8' {_O} WHERE o_custkey % 40 = 8",
    "bonus_ref": f"SELECT o_orderkey::VARCHAR, 'unknown bonus_type b_2' {_O} WHERE o_custkey % 6 = 2 AND o_orderkey % 5 > 1",
    "slot_dup": f"SELECT o_orderkey::VARCHAR, 'slot s0' {_O} WHERE o_orderkey % 3 = 0",
    "min_max": f"SELECT o_orderkey::VARCHAR, 'slot s0' {_O} WHERE o_custkey % 3 > o_orderkey % 4",
    "shared_ref": f"SELECT o_orderkey::VARCHAR, 'unknown option_list list_5' {_O} WHERE o_custkey % 6 = 5 AND o_orderkey % 3 > 0",
    "colour_slot": f"SELECT o_orderkey::VARCHAR, 'unknown colour c_4' {_O} WHERE o_custkey % 5 = 4 UNION ALL SELECT o_orderkey::VARCHAR, 'unknown option_list augments' {_O}",
    "constraint_ref": f"SELECT DISTINCT o_orderkey::VARCHAR, 'slot s' || s {_O}, (SELECT unnest(range(4)) AS s) WHERE (s = o_custkey % 3 OR s = o_orderkey % 4) AND s NOT IN (0, o_orderkey % 3)",
    "redirect_live": f"SELECT o_orderkey::VARCHAR, 'live item ' || {_ITEM} {_O} WHERE o_orderkey % 11 = 0",
    "redirect_target": f"SELECT o_orderkey::VARCHAR, 'unknown item ' || {_UUID.format('lost', 'o_orderkey')} {_O} WHERE o_orderkey % 7 = 1",
    "unique": f"SELECT DISTINCT 'e_9', 'duplicate effect e_9' {_O} WHERE o_custkey % 40 = 8 AND EXISTS (FROM orders WHERE o_custkey % 40 = 9)",
    "counts": f"""SELECT 'meta', t || ' is ' || claimed || ', file has ' || n FROM (SELECT 'effects' AS t, 39 AS claimed, count(*) AS n FROM nested WHERE table_name = 'effects' UNION ALL SELECT 'bonus_types', 5, count(*) FROM nested WHERE table_name = 'bonus_types'
      UNION ALL SELECT 'option_lists', 9, count(*) FROM nested WHERE table_name = 'option_lists' UNION ALL SELECT 'redirects', (SELECT count(*) + 1 {_O}), count(*) FROM nested WHERE table_name = 'redirects') c WHERE claimed <> n""",
}
_ALL = " UNION ALL ".join(f"SELECT '{check}' AS check, * FROM ({sql}) x(subject, detail)" for check, sql in _WRONG.items())


def _rows(nested, *more: str):
    return nested.select("table_name", "subject", F.try_parse_json("json").alias("v"))


def one_check(nested, check: str):
    """(check, subject) of one check of the nested rows."""
    return B.one_check(_rows(nested), check).select("check", "subject", "detail")


register("bundle_problems", lambda nested: B.bundle_problems(_rows(nested)), _ALL, nested=NESTED)
for _name in ("slot_dup", "min_max", "constraint_ref", "shared_ref", "colour_slot"):
    register(f"val_{_name}", partial(one_check, check=_name), f"SELECT '{_name}' AS check, * FROM ({_WRONG[_name]}) x(subject, detail)", nested=NESTED)
# One supplier's row of a wrong shape holds every reference back.
register(
    "bundle_gate", lambda nested, odd: B.bundle_problems(_rows(nested.unionByName(odd)), strict=True),
    "SELECT 'shape' AS check, subject, 'servers .odd: unknown' AS detail FROM odd",
    nested=NESTED, odd="SELECT 'servers' AS table_name, s_name AS subject, '{{\"key\":\"s\",\"name\":\"n\",\"odd\":1}}' AS json FROM {supplier}",
)
