"""Validation of a whole bundle: shapes of all rows first, references between tables only if every table is there and every shape is sound.

A bundle is one relation rows(table_name, subject, v variant). One pass turns every row into facts: keys that it defines, keys that it
needs or must not meet, problems that it shows alone, and the row counts that the meta table claims. Everything after that is
aggregation and joins over the facts, first over distinct keys, so a key that a third of all items name travels once. The gate is a
subquery of the plan: nothing is collected.

Defined results. Sound bundles and empty tables give no row (an empty meta table has no claims). Null and empty bonus types and shared lists,
and null redirect targets, refer to nothing. A slot without options is a colour slot and needs a colour; one with options needs none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import written
from .shapes import COUNTED, SHAPES, shape_problems

#: The file of each table, below a bundle's folder.
FILES = {name: name.replace("_", "-") + ".json" for name in SHAPES}
#: Tables of one object; the others hold one row an element or a line.
SINGLE = ("slot_compat", "meta")
#: The member that is a table's key, and the kind of what it names.
KEYS = {"items": ("id", "item"), "effects": ("key", "effect"), "bonus_types": ("key", "bonus_type"), "option_lists": ("id", "option_list")}

_FACT = "struct<role:string,check:string,kind:string,key:string>"


def bundle_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """rows(table_name, subject, v) of a bundle's tables, and (name) of those without a file.

    A table lies in folder/<table with hyphens>.json, one file or a folder of parts. Tables of rows are JSON Lines, which Spark splits, or
    one array in a file (indented or not, at most 128 MB); slot-compat and meta are one object. What can't be read is a row without v.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.regexp_extract("path", r"/([a-z0-9-]+\.json)(?:/[^/]*)?$", 1).alias("file")).distinct()
    there = {r.file for r in found.where(F.col("file").isin(*FILES.values())).collect()}  # at most one row a table of the bundle
    parts = []
    for name, file in FILES.items():
        if file not in there:
            continue
        path = f"{folder.rstrip('/')}/{file}"
        head = spark.read.text(path).where("trim(value) <> ''").head(1)
        lines = name not in SINGLE and not (head and head[0].value.lstrip("\ufeff \t").startswith("["))
        whole = spark.read.option("multiLine", not lines).option("singleVariantColumn", "v").json(path)
        if not lines and name not in SINGLE:
            whole = whole.select(F.explode(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array(F.lit(None).cast("variant")))).alias("v"))
        parts.append(whole.select(F.lit(name).alias("table_name"), _subject(name).alias("subject"), "v"))
    rows = parts[0] if parts else spark.createDataFrame([], "table_name string, subject string, v variant")
    for more in parts[1:]:
        rows = rows.unionByName(more)
    missing = spark.createDataFrame([(x,) for x, file in FILES.items() if file not in there], "name string")
    return rows, missing


def _subject(table: str) -> Column:
    """What a row is called: its key, else the start of its text."""
    own = F.try_variant_get("v", f"$.{KEYS[table][0]}" if table in KEYS else "$.from" if table == "redirects" else "$.key", "string")
    return F.lit(table) if table in SINGLE else F.coalesce(own, F.left(F.to_json("v"), F.lit(60)))


def _fact(role: str, check: str | Column, kind: str | Column, key: Column) -> Column:
    text = lambda x: (F.lit(x) if isinstance(x, str) else x).cast("string")
    return F.struct(F.lit(role).alias("role"), text(check).alias("check"), text(kind).alias("kind"), key.cast("string").alias("key"))


def _get(path: str, kind: str) -> Column:
    return F.coalesce(F.try_variant_get("v", path, f"array<{kind}>"), F.array().cast(f"array<{kind}>"))


#: What items hold that their facts come from, read once a row.
PARTS = {
    "_effects": ("$.effects", "struct<effect:string,bonus_type:string>"),
    "_slots": ("$.customisation_slots", "struct<id:string,colour:string,min:double,max:double,options:struct<shared:string>>"),
    "_constraints": ("$.constraints", "struct<type:string,slots:array<string>,if_slot:string,then_slot:string>"),
}
#: The checks of items that a row shows alone; the kinds of keys that other checks look up.
INSIDE = ("slot_dup", "min_max", "constraint_ref")
LOOKED_UP = {"effect_ref": ("effect",), "bonus_ref": ("bonus_type",), "colour_slot": ("option_list", "colour"), "shared_ref": ("option_list",), "redirect_live": ("item",), "redirect_target": ("item",)}
CHECKS = (*INSIDE, *LOOKED_UP, "unique", "counts")


def _item_facts(checks: tuple[str, ...]) -> list[Column]:
    """Of a row of items with PARTS: what it needs of other tables, and what is wrong inside it."""
    effects, slots, constraints = (F.col(c) for c in PARTS)
    ids = F.transform(slots, lambda s: s["id"])
    coloured = F.filter(slots, lambda s: s["options"].isNull())
    listed = F.filter(slots, lambda s: s["options"].isNotNull())
    named = F.flatten(F.transform(constraints, lambda c: F.when(c["type"] == "requires", F.array(c["if_slot"], c["then_slot"])).otherwise(F.coalesce(c["slots"], F.array().cast("array<string>")))))
    again = F.filter(F.array_distinct(ids), lambda i: F.size(F.filter(ids, lambda j: j == i)) > 1)
    found = (
        ("effect_ref", F.transform(effects, lambda e: _fact("need", "effect_ref", "effect", e["effect"]))),
        ("bonus_ref", F.transform(F.filter(effects, lambda e: e["bonus_type"] != ""), lambda e: _fact("need", "bonus_ref", "bonus_type", e["bonus_type"]))),
        ("colour_slot", F.transform(coloured, lambda s: _fact("need", "colour_slot", "option_list", F.lit("augments")))),
        ("colour_slot", F.transform(coloured, lambda s: _fact("need", "colour_slot", "colour", F.coalesce(s["colour"], F.lit(""))))),
        ("shared_ref", F.transform(F.filter(listed, lambda s: s["options"]["shared"] != ""), lambda s: _fact("need", "shared_ref", "option_list", s["options"]["shared"]))),
        ("slot_dup", F.transform(again, lambda i: _fact("wrong", "slot_dup", "slot", i))),
        ("min_max", F.transform(F.filter(listed, lambda s: s["min"] > s["max"]), lambda s: _fact("wrong", "min_max", "slot", s["id"]))),
        ("constraint_ref", F.transform(F.array_except(named, ids), lambda i: _fact("wrong", "constraint_ref", "slot", i))),
    )
    return [facts for check, facts in found if check in checks]


def bundle_facts(rows: DataFrame, checks: tuple[str, ...] = CHECKS) -> DataFrame:
    """(subject, role, check, kind, key) of rows(table_name, subject, v). Roles: has, need, avoid, wrong, row (one a row), claim (a count).
    Only what the checks need is read."""
    none = F.array().cast(f"array<{_FACT}>")
    table = F.col("table_name")
    looked_up = {kind for c in checks for kind in LOOKED_UP.get(c, ())}
    own = none
    for name, (member, kind) in KEYS.items():
        if kind in looked_up or "unique" in checks:
            own = F.when(table == name, F.array(_fact("has", "unique", kind, F.try_variant_get("v", f"$.{member}", "string")))).otherwise(own)
    colours = F.map_keys(F.try_variant_get("v", "$.colour_compat", "map<string,variant>"))
    source, target = (F.try_variant_get("v", f"$.{x}", "string") for x in ("from", "to"))
    moved = [f for c, f in (("redirect_live", _fact("avoid", "redirect_live", "item", source)), ("redirect_target", _fact("need", "redirect_target", "item", target))) if c in checks]
    of_item = _item_facts(checks)
    more = {
        "items": F.concat(*of_item) if of_item else None,
        "slot_compat": F.transform(colours, lambda c: _fact("has", "colours", "colour", c)) if "colour" in looked_up else None,
        "redirects": F.filter(F.array(*moved), lambda f: f["key"].isNotNull()) if moved else None,
        "meta": F.array(*[_fact("claim", "counts", t, F.try_variant_get("v", f"$.counts.{t}", "bigint")) for t in COUNTED]) if "counts" in checks else None,
    }
    read = {name for name, facts in more.items() if facts is not None} | {n for n, (_, kind) in KEYS.items() if kind in looked_up or "unique" in checks}
    found = none
    for name, facts in more.items():
        if facts is not None:
            found = F.when(table == name, facts).otherwise(found)
    every = [own, F.coalesce(found, none)]
    if "counts" in checks:
        every = [F.array(_fact("row", "counts", table, F.lit("1"))), *every]
    else:
        rows = rows.where(table.isin(*read))
    parts = {name: F.when(table == "items", _get(*part)) for name, part in PARTS.items()}
    return rows.withColumns(parts).select("subject", F.inline(F.array_distinct(F.concat(*every))))


def reference_problems(facts: DataFrame, checks: tuple[str, ...] = CHECKS) -> DataFrame:
    """(check, subject, detail) of bundle_facts(): keys that are unknown, repeated or taken, problems inside rows, false counts."""
    said = lambda df, detail: df.select("check", "subject", detail.alias("detail"))
    named = F.concat_ws(" ", "kind", "key")
    has = facts.where("role = 'has'").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"), F.max("check").alias("check"))
    found = []
    if "unique" in checks:
        found.append(said(has.where("n > 1 and check = 'unique'").withColumn("subject", F.col("key")), F.concat_ws(" ", F.lit("duplicate"), "kind", "key")))
    if any(c in LOOKED_UP for c in checks):
        asked = facts.where("role in ('need', 'avoid')").select("role", "kind", "key").distinct().join(has.select("kind", "key", F.lit(True).alias("there")), ["kind", "key"], "left")
        bad = asked.where((F.col("role") == "need") != F.coalesce("there", F.lit(False))).select("role", "kind", "key")
        found.append(said(facts.join(bad, ["role", "kind", "key"], "left_semi"), F.concat_ws(" ", F.when(F.col("role") == "need", "unknown").otherwise("live"), "kind", "key")))
    if any(c in INSIDE for c in checks):
        found.append(said(facts.where("role = 'wrong'"), named))
    if "counts" in checks:
        counted = facts.where("role = 'row'").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
        claims = facts.where("role = 'claim'").join(counted, "kind", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        found.append(said(claims.where("not (n <=> try_cast(key as bigint))"), F.concat(F.col("kind"), F.lit(" is "), F.coalesce("key", F.lit("null")), F.lit(", file has "), F.col("n"))))
    return reduce(DataFrame.unionByName, found)


def one_check(rows: DataFrame, check: str) -> DataFrame:
    """(check, subject, detail) of one check of rows(table_name, subject, v), whatever the shapes; facts that others look up are written, so rows
    are read once."""
    facts = bundle_facts(rows, (check,))
    return reference_problems(facts if check in INSIDE else written(facts), (check,)).where(F.col("check") == check)


def bundle_problems(rows: DataFrame, missing: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """(check, subject, detail) of a bundle's rows(table_name, subject, v) and missing(name). Problems of references come only if no file is
    missing and no shape is wrong; strict rejects unknown members, too."""
    shape = shape_problems(rows, strict).select(F.lit("shape").alias("check"), "subject", F.concat_ws(" ", "table_name", "problem").alias("detail"))
    if missing is not None:
        shape = shape.unionByName(missing.select(F.lit("missing").alias("check"), F.col("name").alias("subject"), F.lit("no file").alias("detail")))
    broken = written(shape)
    facts = written(bundle_facts(rows).where(~broken.exists()))
    return broken.unionByName(reference_problems(facts))
