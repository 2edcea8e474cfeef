"""Shapes of the eight bundle tables: what a JSON row must hold, as data, and the problems of rows, as one SQL expression.

Shapes are open: other keys pass. strict closes every object that names its members, at any depth.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import SLUG, UUID, VERSION


#: The pattern of any text.
ANY = "(?s)^.*$"


@dataclass(frozen=True)
class Text:
    pattern: str = ANY
    least: int = 0
    most: int = 1 << 30
    one_of: tuple[str, ...] = ()


@dataclass(frozen=True)
class Flag:
    pass


@dataclass(frozen=True)
class Number:
    whole: bool = False
    least: int | None = None


@dataclass(frozen=True)
class Maybe:
    """null, or the inner shape."""

    inner: object


@dataclass(frozen=True)
class List:
    item: object
    least: int = 0


@dataclass(frozen=True)
class Table:
    """An object with any keys and values of one shape."""

    value: object


@dataclass(frozen=True)
class Row:
    members: dict[str, object] = field(hash=False)
    needed: tuple[str, ...] = ()


# The shapes of the bundle's tables.
KEY, NAME = Text(SLUG, most=80), Text(least=1)
COUNTED = ("items", "effects", "bonus_types", "option_lists", "servers", "redirects")
OPTION = Row({"key": KEY, "name": NAME, "colour": Maybe(Text()), "level": Maybe(Number(True)), "value": Maybe(Number()), "tooltip": Maybe(Text())}, ("key", "name"))
RULE = Row({"kind": KEY, "category_in": List(Text(one_of=("weapon", "armor", "shield", "jewelry", "clothing", "other"))), "allow_options": List(KEY)}, ("kind", "allow_options"))
USED = Row({"effect": KEY, "bonus_type": Maybe(Text()), "value": Maybe(Number())}, ("effect",))
SLOT = Row({"id": Text(least=1), "kind": KEY, "colour": Text(), "min": Number(True, 0), "max": Number(True, 0), "options": Row({"shared": KEY})}, ("id", "kind"))
WHOLE, SAID = Maybe(Number(True)), Maybe(Text())
WIKI = Row({"page_id": WHOLE, "revision_id": WHOLE, "title": SAID, "url": Text()}, ("url",))
# Of two forms: "requires" names two slots, the others a list of them and a count.
CONSTRAINT = Row({"type": Text(least=1), "slots": List(Text()), "count": Number(True, 0), "if_slot": Text(), "then_slot": Text()}, ("type",))
WEAPON = Row({"proficiency": SAID, "weapon_type": SAID, "handedness": SAID, "damage_multiplier": Maybe(Number()), "damage_dice": SAID, "damage_bonus": WHOLE, "enhancement_bonus": WHOLE, "damage_types": Maybe(List(Text())), "critical_range": SAID, "critical_multiplier": WHOLE, "attack_mod": SAID, "damage_mod": SAID})
ARMOR = Row({"armor_type": SAID, "armor_bonus": WHOLE, "armor_bonus_variants": Maybe(List(Row({"name": Text(), "value": Number(True)}, ("name", "value")))), "max_dex_bonus": WHOLE, "armor_check_penalty": WHOLE, "arcane_spell_failure": WHOLE})
SHIELD = Row({"shield_type": SAID, "shield_bonus": WHOLE, "damage_reduction": WHOLE})
ITEM = {
    "id": Text(UUID), "name": NAME, "category": Text(least=1), "item_type": SAID, "introduced_update": SAID, "minimum_level": WHOLE, "binding": SAID, "effects": List(USED), "wiki": WIKI, "slots_status": Text(least=1),
    "customisation_slots": List(SLOT), "constraints": List(CONSTRAINT), "equip_slots": List(Text()), "weapon_stats": Maybe(WEAPON), "armor_stats": Maybe(ARMOR), "shield_stats": Maybe(SHIELD),
}
SHAPES = {
    "items": Row(ITEM, ("id", "name", "category")),
    "effects": Row({"key": KEY, "name": NAME, "tooltip": Maybe(Text()), "verified": Flag()}, ("key", "name")),
    "bonus_types": Row({"key": KEY, "name": NAME, "stacks_with_self": Maybe(Flag()), "verified": Flag()}, ("key", "name")),
    "option_lists": Row({"id": KEY, "kind": KEY, "options": List(OPTION, 1)}, ("id", "options")),
    "servers": Row({"key": KEY, "name": NAME}, ("key", "name")),
    "redirects": Row({"from": Text(UUID), "to": Maybe(Text(UUID))}, ("from", "to")),
    "slot_compat": Row({"colour_compat": Table(List(Text())), "kind_rules": List(RULE)}, ("colour_compat", "kind_rules")),
    "meta": Row({"format_version": Number(True, 1), "catalog_version": Text(VERSION), "generated_at": Text(), "source_commit": Text(), "counts": Row({k: Number(True, 0) for k in COUNTED}, COUNTED)}, ("format_version", "catalog_version", "generated_at", "counts")),
}


_NONE = "cast(array() as array<string>)"


def _said(problem: str) -> str:
    return f"array('{problem}')"


def _if(bad: str, problem: str) -> str:
    return f"if(coalesce({bad}, false), {_said(problem)}, {_NONE})"


def _bound(value: str, depth: int, then: Callable[[str], str]) -> str:
    """then(value) as SQL, with the value named once however often then() uses it."""
    return f"get(transform(array({value}), x{depth} -> {then(f'x{depth}')}), 0)"


def problems(value: str, shape, path: str = "", strict: bool = False, depth: int = 0) -> str:
    """SQL for array<string> of what is wrong with a variant, each with its path. A missing value is the row's affair."""
    here, x = path or ".", f"x{depth}"
    # A schema goes through all that a value holds, so only plain values are asked for theirs.
    kind, no_object = f"schema_of_variant({value})", f"try_variant_get({value}, '$', 'struct<>') is null"
    if isinstance(shape, Maybe):
        return f"if(is_variant_null({value}), {_NONE}, {problems(value, shape.inner, path, strict, depth)})"
    if isinstance(shape, Flag):
        return _if(f"{kind} <> 'BOOLEAN'", f"{here}: type")
    if isinstance(shape, Number):
        # Whole numbers read as BIGINT, others as DECIMAL(p,s) or DOUBLE; 5.0 is a whole number too.
        number = f"try_variant_get({value}, '$', 'double')"
        sound = f"{kind} rlike '^(BIGINT|DECIMAL|DOUBLE)'" + (f" and {number} = floor({number})" if shape.whole else "")
        low = _NONE if shape.least is None else _if(f"{number} < {shape.least}", f"{here}: minimum")
        return f"if({sound}, {low}, {_said(f'{here}: type')})"
    if isinstance(shape, Text):
        tests = [t for t, used in ((f"not {x} rlike r'{shape.pattern}'", shape.pattern != ANY), (f"length({x}) < {shape.least}", shape.least), (f"length({x}) > {shape.most}", shape.most < 1 << 30)) if used]
        tests += [f"{x} not in ({', '.join(map(repr, shape.one_of))})"] if shape.one_of else []
        good = _bound(f"try_variant_get({value}, '$', 'string')", depth, lambda _: _if(" or ".join(tests), f"{here}: text")) if tests else _NONE
        return f"if({kind} <> 'STRING', {_said(f'{here}: type')}, {good})"
    if isinstance(shape, List):
        inner = f"flatten(transform({x}, x{depth + 1} -> {problems(f'x{depth + 1}', shape.item, f'{path}[]', strict, depth + 2)}))"
        few = [_if(f"size({x}) < {shape.least}", f"{here}: too few")] if shape.least else []
        return _bound(f"try_variant_get({value}, '$', 'array<variant>')", depth, lambda _: f"if({x} is null, {_said(f'{here}: type')}, concat({', '.join([*few, inner])}))")
    if isinstance(shape, Table):
        rows = f"map_values(try_variant_get({value}, '$', 'map<string,variant>'))"
        return f"if({no_object}, {_said(f'{here}: type')}, flatten(transform({rows}, {x} -> {problems(x, shape.value, f'{path}{{}}', strict, depth + 1)})))"
    found = []
    for name, inner in shape.members.items():
        lost = _said(f"{path}.{name}: missing") if name in shape.needed else _NONE
        found.append(_bound(f"try_variant_get({value}, '$.{name}', 'variant')", depth, lambda _, inner=inner, name=name, lost=lost: f"if({x} is null, {lost}, {problems(x, inner, f'{path}.{name}', strict, depth + 1)})"))
    if strict:
        known = ", ".join(map(repr, shape.members))
        found.append(f"transform(array_except(map_keys(try_variant_get({value}, '$', 'map<string,variant>')), array({known})), {x} -> concat('{path}.', {x}, ': unknown'))")
    return f"if({no_object}, {_said(f'{here}: type')}, concat({', '.join(found)}))"


def shape_problems(rows: DataFrame, strict: bool = False) -> DataFrame:
    """(table_name, subject, problem) of rows(table_name, subject, json or v variant) of the bundle's tables; unreadable JSON is one problem."""
    value = F.col("v") if "v" in rows.columns else F.try_parse_json("json")
    found = F.when(F.col("v").isNull(), F.array(F.lit(".: json")))
    for name, shape in SHAPES.items():
        found = found.when(F.col("table_name") == name, F.expr(problems("v", shape, "", strict)))
    return rows.withColumn("v", value).select("table_name", "subject", F.explode(F.array_distinct(found)).alias("problem"))
