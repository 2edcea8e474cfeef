"""Integrity checks of catalog files and bundles: every check yields rows (check, subject); sound data yields none."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.canonical import rendered
from ..functions.text import category_folder, file_slug

# Shapes of item files' paths and of update folders.
PATH = r"^([^/]+)/([^/]+)/([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})-([a-z0-9-]+)\.json$"
UPDATE = r"^(update-[1-9]\d*|unknown)$"
# Shapes of ids and versions in bundles.
SLUG = "^[a-z0-9]+(?:_[a-z0-9]+)*$"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[1-8][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
VERSION = r"^\d{4}\.\d{2}\.\d{2}\.\d{4}$"


def violations(rows: DataFrame, check: str, subject: str, bad: Column) -> DataFrame:
    """(check, subject) of the rows where bad holds; unknown counts as sound."""
    return rows.where(F.coalesce(bad, F.lit(False))).select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"))


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def path_parts(files: DataFrame) -> DataFrame:
    """files(path, record) with the parts of the path and whether it has the shape of an item file's."""
    part = lambda k: F.nullif(F.regexp_extract("path", PATH, k), F.lit(""))
    return files.withColumns({"p_update": part(1), "p_category": part(2), "p_uuid": part(3), "p_slug": part(4)})


def parsed_records(files: DataFrame, schema: str) -> DataFrame:
    """path_parts() rows of a good shape with the record's keys and fields; rec is null if it cannot be read."""
    return path_parts(files).where("p_uuid is not null").withColumns({"keys": F.expr("json_object_keys(record)"), "rec": F.from_json("record", schema, {"columnNameOfCorruptRecord": BROKEN})})


# The item record's members in their order, with their types.
EFFECT = "struct<name:string,value:double,value_kind:string,bonus_type:string,tooltip:string,charges:bigint,recharge_per_day:bigint,note:string>"
HINT = "struct<kind:string,raw:string,name:string,colour:string,text:string,children:array<string>>"
WEAPON = "struct<proficiency:string,weapon_type:string,handedness:string,damage_multiplier:double,damage_dice:string,damage_bonus:bigint,enhancement_bonus:bigint,damage_types:array<string>,critical_range:string,critical_multiplier:bigint,attack_mod:string,damage_mod:string>"
ARMOR = "struct<armor_type:string,armor_bonus:bigint,armor_bonus_variants:array<struct<name:string,value:bigint>>,max_dex_bonus:bigint,armor_check_penalty:bigint,arcane_spell_failure:bigint>"
SHIELD = "struct<shield_type:string,shield_bonus:bigint,damage_reduction:bigint>"
SET = "struct<name:string,bonuses:array<struct<pieces:bigint,text:string,bonus_type:string>>>"
MEMBERS = {
    "id": "string",
    "name": "string",
    "wiki": "struct<page_id:bigint,revision_id:bigint,title:string,url:string>",
    **dict.fromkeys(("template", "category", "item_type"), "string"),
    "equip_slots": "array<string>",
    "minimum_level": "bigint",
    **dict.fromkeys(("required_race", "excluded_race", "required_class", "required_feat", "required_trait", "binding", "binding_raw"), "string"),
    "exclusive": "boolean",
    "material": "string",
    **dict.fromkeys(("hardness", "durability", "base_value_cp"), "bigint"),
    "weight": "double",
    "upgradeable": "string",
    "accepts_sentience": "boolean",
    **dict.fromkeys(("umd_dc", "umd_exempt_classes"), "string"),
    "weapon_stats": WEAPON,
    "armor_stats": ARMOR,
    "shield_stats": SHIELD,
    "effects": f"array<{EFFECT}>",
    "customisation_hints": f"array<{HINT}>",
    "named_set": SET,
    **dict.fromkeys(("flavor_text", "notes", "tips"), "string"),
    "source": "struct<quests:array<string>,detail:string,crafted_from:array<string>,raw:string>",
    "extraction_errors": "map<string,string>",
}
#: Members that an item may not lack, and the member of from_json() that is set where a value has another type.
NEEDED, BROKEN = ("id", "wiki.url", "template", "category"), "_broken"
RECORD = ", ".join(f"{k} {v}" for k, v in MEMBERS.items()) + f", {BROKEN} string"


#: The record's type as it is written: an effect's value is the text of its number, since whole numbers and floats are told apart.
_WRITTEN_DDL = ", ".join(f"{k} {v}" for k, v in MEMBERS.items()).replace(EFFECT, EFFECT.replace("value:double", "value:string"))


def written_type() -> StructType:
    return StructType.fromDDL(_WRITTEN_DDL)


def record_text(record: str) -> Column:
    """The exact text of an item file of a struct of written_type(), newline at the end. The writer and the check share it."""
    return F.concat(F.expr(rendered(record, written_type(), numbers=frozenset({"effects.value"}))), F.lit("\n"))


def canonical_text(record: str) -> Column:
    """What a column of record texts would be, had the writer written them."""
    return record_text(f"from_json({record}, '{_WRITTEN_DDL}')")


def item_file_checks(files: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    """The checks of item files(path, record json) against registry(id, page_id), by name."""
    shaped, parsed = path_parts(files), parsed_records(files, RECORD)
    broken = F.col("keys").isNull() | (F.get("keys", F.lit(0)) != "id") | F.col(f"rec.{BROKEN}").isNotNull() | (F.size(F.array_except("keys", F.array(*map(F.lit, MEMBERS)))) > 0)
    broken = reduce(or_, [F.col(f"rec.{c}").isNull() for c in NEEDED], broken)
    good = parsed.where(~F.coalesce(broken, F.lit(True)))
    known = good.join(registry.select(F.col("id").alias("r_id"), F.col("page_id").alias("r_page")), F.col("rec.id") == F.col("r_id"), "left")
    many = shaped.where("p_uuid is not null").groupBy("p_uuid").agg(F.count("*").alias("n"))
    return {
        "chk_path_shape": violations(shaped, "path_shape", "path", F.col("p_uuid").isNull()),
        "chk_record": violations(parsed, "record", "path", F.coalesce(broken, F.lit(True))),
        "chk_id_filename": violations(good, "id_filename", "path", F.col("rec.id") != F.col("p_uuid")),
        "chk_canonical": violations(good, "canonical", "path", canonical_text("record") != F.col("record")),
        "chk_registered": violations(known, "registered", "path", F.col("r_id").isNull()),
        "chk_page_id": violations(known, "page_id", "path", F.col("r_id").isNotNull() & ~F.col("rec.wiki.page_id").eqNullSafe(F.col("r_page"))),
        "chk_update_folder": violations(good, "update_folder", "path", ~F.col("p_update").rlike(UPDATE)),
        "chk_category_folder": violations(good, "category_folder", "path", category_folder(F.col("rec.category")) != F.col("p_category")),
        "chk_slug": violations(good, "slug", "path", file_slug(F.col("rec.name")) != F.col("p_slug")),
        "chk_one_file": violations(many, "one_file", "p_uuid", F.col("n") > 1),
    }


def missing_tables(found: DataFrame, wanted: list[str]) -> DataFrame:
    """Names of wanted that found(name) lacks."""
    return found.sparkSession.createDataFrame([(x,) for x in wanted], "name string").join(found, "name", "left_anti")


def duplicates(rows: DataFrame, key: str, check: str) -> DataFrame:
    return violations(rows.groupBy(key).agg(F.count("*").alias("n")), check, key, (F.col("n") > 1) & F.col(key).isNotNull())


def dangling(refs: DataFrame, ref: str, targets: DataFrame, key: str, check: str, subject: str) -> DataFrame:
    """Rows whose non-empty reference names no target."""
    lost = refs.where(F.coalesce(F.col(ref).cast("string"), F.lit("")) != "").join(targets.select(F.col(key).alias("_key")), F.col(ref) == F.col("_key"), "left_anti")
    return lost.select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"))


def meta_counts(counts: DataFrame, claimed: DataFrame) -> DataFrame:
    """(table_name, n, claimed) where a table's rows differ from what the meta table claims."""
    return claimed.join(counts, "table_name", "left").where("not (coalesce(n, 0) <=> claimed)").select("table_name", F.coalesce("n", F.lit(0)).alias("n"), "claimed")
