"""The bundle reader and validator on files: a sound bundle in open and strict form, and one planted fault of each kind."""

from __future__ import annotations

import copy
import json

import pytest

from millrace.operators.bundle import FILES, bundle_problems, bundle_rows
from millrace.sources.tables import scan_bundle

_ID = "{}0000000-0000-4000-8000-000000000000"
SOUND = {
    "items": [
        {
            "id": _ID.format("a"), "name": "Ring", "category": "jewelry", "item_type": "Ring", "introduced_update": "Update 3", "minimum_level": 4, "binding": "account", "slots_status": "known",
            "effects": [{"effect": "luck", "bonus_type": "deep", "value": 2.5}, {"effect": "glow"}, {"effect": "glow", "bonus_type": None}, {"effect": "luck", "bonus_type": ""}],
            "wiki": {"page_id": 7, "title": "Item:Ring", "revision_id": 3, "url": "u"},
            "customisation_slots": [{"id": "m", "kind": "mythic", "min": 0, "max": 1, "options": {"shared": "boosts"}}, {"id": "c", "kind": "augment", "colour": "red", "min": 2, "max": 1}, {"id": "o", "kind": "own", "min": 0, "max": 0, "options": {}}],
            "constraints": [{"type": "requires", "if_slot": "m", "then_slot": "c"}, {"type": "max_selected", "slots": ["m", "c"], "count": 1}],
            "equip_slots": ["finger"],
        },
        {"id": _ID.format("b"), "name": "Sword", "category": "weapon", "wiki": {"page_id": None, "url": "u"}, "slots_status": "unknown", "equip_slots": [], "weapon_stats": {"damage_dice": "1d8", "critical_multiplier": 2, "damage_multiplier": 1.5}},
    ],
    "effects": [{"key": "luck", "name": "Luck", "tooltip": None}, {"key": "glow", "name": "Glow"}],
    "bonus_types": [{"key": "deep", "name": "Deep", "stacks_with_self": False}],
    "option_lists": [{"id": "boosts", "kind": "mythic", "options": [{"key": "b_1", "name": "B", "value": 1}]}, {"id": "augments", "options": [{"key": "r", "name": "R", "colour": "red", "level": 2}]}],
    "servers": [{"key": "s", "name": "S"}],
    "redirects": [{"from": _ID.format("1"), "to": None}, {"from": _ID.format("2"), "to": _ID.format("a")}],
    "slot_compat": {"colour_compat": {"red": ["red"], "blue": []}, "kind_rules": [{"kind": "mythic", "allow_options": ["b_1"]}]},
    "meta": {"format_version": 1, "catalog_version": "2026.01.02.0003", "generated_at": "t", "counts": {"items": 2, "effects": 2, "bonus_types": 1, "option_lists": 2, "servers": 1, "redirects": 2}},
}


def problems(spark, folder, tables: dict, strict: bool = False, indent: int | None = 1, lines: bool = False) -> set[tuple]:
    folder.mkdir()
    for name, rows in tables.items():
        one_a_line = lines and isinstance(rows, list)
        text = "\n".join(map(json.dumps, rows)) + "\n" if one_a_line else json.dumps(rows, indent=indent)
        (folder / FILES[name]).write_text(text)
    return {(r.check, r.subject, r.detail) for r in bundle_problems(*bundle_rows(spark, str(folder)), strict=strict).collect()}


def test_sound_bundle(spark, tmp_path):
    assert problems(spark, tmp_path / "open", SOUND) == set()
    assert problems(spark, tmp_path / "strict", SOUND, strict=True, lines=True) == set()
    few = {"items": [], "effects": [], "bonus_types": [], "option_lists": [], "servers": [], "redirects": [], "slot_compat": SOUND["slot_compat"], "meta": {**SOUND["meta"], "counts": dict.fromkeys(SOUND["meta"]["counts"], 0)}}
    assert problems(spark, tmp_path / "empty", few, indent=None) == set()


def test_one_row_for_each_planted_reference(spark, tmp_path):
    bad = copy.deepcopy(SOUND)
    ring, sword = bad["items"]
    ring["effects"] += [{"effect": "lost"}, {"effect": "luck", "bonus_type": "odd"}]
    ring["customisation_slots"] += [{"id": "m", "kind": "k", "colour": "green"}, {"id": "x", "kind": "k", "min": 3, "max": 1, "options": {"shared": "none"}}]
    ring["constraints"] += [{"type": "requires", "if_slot": "m", "then_slot": "gone"}, {"type": "max_selected", "slots": ["away"], "count": 1}]
    sword["customisation_slots"] = [{"id": "y", "kind": "k"}]
    bad["effects"].append({"key": "glow", "name": "Again"})
    bad["redirects"] += [{"from": ring["id"], "to": None}, {"from": _ID.format("3"), "to": _ID.format("4")}]
    a, b = ring["id"], sword["id"]
    assert problems(spark, tmp_path / "b", bad, strict=True) == {
        ("effect_ref", a, "unknown effect lost"), ("bonus_ref", a, "unknown bonus_type odd"), ("slot_dup", a, "slot m"), ("colour_slot", a, "unknown colour green"), ("colour_slot", b, "unknown colour "),
        ("min_max", a, "slot x"), ("shared_ref", a, "unknown option_list none"), ("constraint_ref", a, "slot gone"), ("constraint_ref", a, "slot away"), ("unique", "glow", "duplicate effect glow"),
        ("redirect_live", a, f"live item {a}"), ("redirect_target", _ID.format("3"), f"unknown item {_ID.format('4')}"), ("counts", "meta", "effects is 2, file has 3"), ("counts", "meta", "redirects is 2, file has 4"),
    }
    bad = copy.deepcopy(SOUND)
    bad["option_lists"].pop()
    bad["meta"]["counts"]["option_lists"] = 1
    assert problems(spark, tmp_path / "c", bad) == {("colour_slot", a, "unknown option_list augments")}


@pytest.mark.parametrize("strict", [False, True])
def test_shapes_and_missing_files_hold_references_back(spark, tmp_path, strict):
    bad = copy.deepcopy(SOUND)
    del bad["servers"]
    bad["items"][0]["effects"].append({"effect": "lost"})
    bad["items"][1]["weapon_stats"]["damage_dice"] = 8
    bad["effects"][1]["odd"] = 1
    want = {("missing", "servers", "no file"), ("shape", _ID.format("b"), "items .weapon_stats.damage_dice: type")}
    assert problems(spark, tmp_path / "b", bad, strict=strict) == want | ({("shape", "glow", "effects .odd: unknown")} if strict else set())
    (tmp_path / "b" / FILES["effects"]).write_text('[{"key": "luck", ')
    found = bundle_problems(*bundle_rows(spark, str(tmp_path / "b"))).collect()
    assert {(r.check, r.detail) for r in found} >= {("shape", "effects .: json")} and not any(r.check == "effect_ref" for r in found)


def test_tables_of_indented_arrays_and_hyphenated_names(spark, tmp_path):
    for name, rows in SOUND.items():
        if name != "servers":
            (tmp_path / FILES[name]).write_text(json.dumps(rows, indent=2))
    kinds = {"items": "id string, minimum_level bigint", "bonus_types": "key string", "slot_compat": "colour_compat map<string,array<string>>", "servers": "key string"}
    tables, missing = scan_bundle(spark, str(tmp_path), kinds)
    assert [r.name for r in missing.collect()] == ["servers"]
    assert sorted((r.id, r.minimum_level) for r in tables["items"].collect()) == [(_ID.format("a"), 4), (_ID.format("b"), None)]
    assert [r.key for r in tables["bonus_types"].collect()] == ["deep"] and tables["slot_compat"].first().colour_compat == {"red": ["red"], "blue": []}


def test_one_check_reads_the_rows_once(spark, tmp_path):
    from millrace.plans.bundle_queries import one_check

    item = '{"id":"a","name":"n","category":"weapon","customisation_slots":[{"id":"s0","kind":"k","min":2,"max":1,"options":{"shared":"lost"}},{"id":"s0","kind":"k","colour":"c"}],"constraints":[{"type":"max","slots":["s9"],"count":1}]}'
    spark.createDataFrame([("items", "a", item)], "table_name string, subject string, json string").write.parquet(f"{tmp_path}/nested")
    nested = spark.read.parquet(f"{tmp_path}/nested")
    found = {"min_max": "slot s0", "slot_dup": "slot s0", "constraint_ref": "slot s9", "shared_ref": "unknown option_list lost"}
    for check, detail in found.items():
        rows = one_check(nested, check)
        assert [tuple(r) for r in rows.collect()] == [(check, "a", detail)]
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [table_name") <= (check != "shared_ref"), check


def test_the_schema_of_a_whole_row_is_never_made():
    from millrace.operators.shapes import SHAPES, problems

    for name, shape in SHAPES.items():
        assert "schema_of_variant(v)" not in problems("v", shape, strict=True), name
