"""Whole items: every field of the item schema from a page's picked table, one row a page.

The parse runs once and is written to the shared folder; fields, effects, hints and sets are column work over its rows,
and meet by page. A page without a table that can be picked yields no row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.text import page_categories, page_meta
from ..workers import shelved, tasks
from . import entries as E
from . import infobox as I
from .catalog import minted_id

# Types of the values that coercers give, and the members of the three groups of stats.
KINDS = {
    "int": "bigint",
    "copper": "bigint",
    "float": "double",
    "text": "string",
    "first_segment": "string",
    "yes_no": "boolean",
    "binding": "struct<binding:string,binding_raw:string,exclusive:boolean>",
    "damage": "struct<multiplier:double,dice:string,bonus:bigint,enhancement:bigint,types:array<string>>",
    "crit": "struct<range:string,multiplier:bigint>",
    "armor_bonus": "struct<bonus:bigint,variants:array<struct<name:string,value:bigint>>>",
    "location": "struct<quests:array<string>,crafted_from:array<string>,detail:string,raw:string>",
}
TARGETS = {target: coercer for target, coercer in I.FIELDS.values()}


def picked_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of parse_pages(): the cells of each page's table, and the entries of the first effects cell in it."""
    picked = I.picked_tables(parsed.where("kind = 'cell'")).hint("shuffle_hash")
    # Rows meet by page alone, as they lie; a table or row among the keys would cost a shuffle.
    cells = I.cell_links(parsed).join(picked, "page_id").where("table - best = 0").withColumnRenamed("table", "a")
    entries = parsed.where("kind = 'entry'").join(picked, "page_id").where("a - best = 0 and b - first = 0")
    return cells.drop("best", "first"), entries.select("page_id", F.col("label").cast("int").alias("entry_pos"), "text", "tooltip", "hrefs", "children", "tooltip_items")


def typed_rows(mapped: DataFrame) -> DataFrame:
    """map_rows() with a typed column c_<coercer> each, null but for the row's own, and whether the text could be read."""
    used = F.col("target").isNotNull() & ~F.col("is_null")
    links = F.col("links") if "links" in mapped.columns else F.lit(None).cast("array<struct<href:string,text:string,in_bold:boolean>>")
    make = {name: f(F.col("text")) for name, f in coerce.COERCERS.items()} | {"location": coerce.location(F.col("text"), links)}
    rows = mapped.withColumns({f"c_{name}": F.when(used & (F.col("coercer") == name), value) for name, value in make.items()})
    parts = {"binding": "c_binding.binding is not null", "armor_bonus": "c_armor_bonus.bonus is not null or c_armor_bonus.variants is not null"}
    read = " or ".join(parts.get(name, f"c_{name} is not null") for name in make)
    return rows.withColumns({"used": used, "read": F.expr(read)})


def typed_fields(cells: DataFrame) -> DataFrame:
    """(page_id, template, f_<target> of every target, errors map) of the picked cells: one row a page, by one aggregation. A target's value is
    that of its last row that could be read, an error the last text that could not."""
    rows = typed_rows(I.map_rows(cells))
    held = " or ".join(f"c_{c} is not null" for c in KINDS)
    kept = F.when(F.col("used"), F.struct((-F.col("row_pos")).alias("at"), "target", "text", "read", F.expr(held).alias("held"), *[f"c_{c}" for c in KINDS]))
    # A table's rows differ in their place, so the newest stand first.
    pages = rows.groupBy("page_id").agg(F.min_by("label", "row_pos").alias("first"), F.collect_set("label").alias("labels"), F.sort_array(F.collect_list(kept)).alias("r"))
    pages = pages.select("page_id", I.template_of(F.col("first"), F.col("labels")).alias("template"), F.expr("filter(r, x -> x.held) as held"), F.expr("filter(r, x -> not x.read) as unread"))
    # Names of targets beside the rows: a target's row is found by its place among the names, and no row is judged again for each target.
    pages = pages.select("*", F.expr("held.target as targets"), F.expr("unread.target as odd"))
    last = [f"get(held, cast(array_position(targets, '{t}') as int) - 1).c_{c} as f_{t.replace('.', '_')}" for t, c in TARGETS.items()]
    errors = "map_from_entries(array_sort(transform(filter(unread, (x, i) -> array_position(odd, x.target) = i + 1), x -> struct(x.target, x.text)))) as errors"
    return pages.select("page_id", "template", F.expr(errors), *map(F.expr, last))


def entry_fields(entries: DataFrame) -> DataFrame:
    """(page_id, effects, customisation_hints, named_set) of pages with entries: arrays of structs in order."""
    matched = shelved(E.captures(E.first_match(E.split_note(entries))), "page_id")
    value = ("name", "value", "value_is_float", "value_kind", "bonus_type", "tooltip", "charges", "recharge_per_day", "note")
    in_order = lambda rows, *names: F.transform(F.array_sort(F.collect_list(F.struct("entry_pos", F.struct(*names).alias("x")))), lambda r: r["x"])
    effects = E.effects(matched, "tooltip")
    effects = effects.groupBy("page_id").agg(in_order(effects, *value).alias("effects"))
    hints = E.hints(matched)
    hints = hints.groupBy("page_id").agg(in_order(hints, F.col("hint_kind").alias("kind"), "raw", "name", "colour", F.col("hint_text").alias("text"), F.coalesce("children", F.array().cast("array<string>")).alias("children")).alias("customisation_hints"))
    names = matched.where("kind = 'set'").groupBy("page_id").agg(F.max_by("g_name", "entry_pos").alias("name"))
    rows = E.set_bonuses(matched).select("page_id", F.struct((~F.col("from_set")).alias("bare"), "entry_pos", "item_pos", F.struct("pieces", F.col("bonus_text").alias("text"), "bonus_type").alias("x")).alias("b"))
    bonuses = rows.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list("b")), lambda r: r["x"]).alias("bonuses"))
    sets = names.join(bonuses, "page_id", "full_outer").select("page_id", F.struct("name", F.coalesce("bonuses", F.array().cast("array<struct<pieces:bigint,text:string,bonus_type:string>>")).alias("bonuses")).alias("named_set"))
    return effects.join(hints, "page_id", "full_outer").join(sets, "page_id", "full_outer")


def _group_of(members: dict[str, Column]) -> Column:
    """A struct of the members, null if none is set."""
    return F.when(reduce(or_, [c.isNotNull() for c in members.values()]), F.struct(*[c.alias(k) for k, c in members.items()]))


#: A page's row of kind page carries this beside its outcome, so the html is read once.
HEAD = "page_key bigint, url string, meta struct<page_id:bigint,revision_id:bigint,title:string,name:string>, categories array<string>"


def read_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The parse of all pages, keyed by row: pages of one id stay apart. It is written once, in buckets by that key, so that nothing
    that follows shuffles it. Every page has a row of kind page."""
    key = [F.col(c).alias(n) if c in pages.columns else F.lit(None).alias(n) for c, n in ((id_col, "page_key"), (url_col, "url"))]
    head = F.to_json(F.struct(*key, page_meta(F.col(html_col)).alias("meta"), page_categories(F.col(html_col)).alias("categories")))
    rows = pages.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.col(html_col).alias("_html"), head.alias("_head"))
    return shelved(I.parse_pages(rows.repartition(tasks(pages.sparkSession), "_row"), "_row", "_html", F.col("_head"), dealt=True), "page_id")


def page_heads(parsed: DataFrame) -> DataFrame:
    """(page_id, label, text, page_key, url, meta, categories) of read_pages(), one row a page; page_id is the row's key."""
    return parsed.where("kind = 'page'").select("page_id", "label", "text", F.from_json("tooltip", HEAD).alias("h")).select("page_id", "label", "text", "h.*")


def extract_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", registry: DataFrame | None = None) -> DataFrame:
    """The item row of every page with a table: id, name, wiki, … extraction_errors, every field always, in the schema's order;
    beside them page_key, the page's key in the input. An id is the registry's (id, page_id), else minted from the page id."""
    return items_of(read_pages(pages, id_col, html_col, url_col), registry).drop("row")


def items_of(parsed: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """extract_items() of read_pages(), with row, the page's key in it."""
    cells, entries = picked_rows(parsed)
    head = page_heads(parsed).drop("label", "text")
    rows = typed_fields(cells).join(entry_fields(entries), "page_id", "left").join(head, "page_id")
    own = minted_id(F.col("meta.page_id"))
    if registry is not None:
        rows = rows.join(registry.select(F.col("id").alias("known_id"), F.col("page_id").alias("known_page")), F.col("meta.page_id") == F.col("known_page"), "left")
        own = F.coalesce("known_id", own)
    f = lambda t: F.col(f"f_{t.replace('.', '_')}")
    rows = I.derive(rows.withColumns({"item_type": f("item_type"), "slot": f("slot"), **{f"{k}_type": f(f"{k}_stats.{k}_type") for k in ("weapon", "armor", "shield")}}))
    text = lambda *names: [f(n).alias(n) for n in names]
    weapon = {k: f(f"weapon_stats.{k}") for k in ("proficiency", "weapon_type", "handedness")}
    dice, critical = f("weapon_stats.damage_dice"), f("weapon_stats.critical_range")
    weapon |= {"damage_multiplier": dice["multiplier"], "damage_dice": dice["dice"], "damage_bonus": dice["bonus"], "enhancement_bonus": dice["enhancement"], "damage_types": dice["types"]}
    weapon |= {"critical_range": critical["range"], "critical_multiplier": critical["multiplier"], **{k: f(f"weapon_stats.{k}") for k in ("attack_mod", "damage_mod")}}
    bonus = f("armor_stats.armor_bonus")
    armor = {"armor_type": f("armor_stats.armor_type"), "armor_bonus": bonus["bonus"], "armor_bonus_variants": bonus["variants"]}
    armor |= {k: f(f"armor_stats.{k}") for k in ("max_dex_bonus", "armor_check_penalty", "arcane_spell_failure")}
    shield = {k: f(f"shield_stats.{k}") for k in ("shield_type", "shield_bonus", "damage_reduction")}
    bound, source = f("binding"), f("source")
    listed = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    effect = "array<struct<name:string,value:double,value_is_float:boolean,value_kind:string,bonus_type:string,tooltip:string,charges:bigint,recharge_per_day:bigint,note:string>>"
    hint = "array<struct<kind:string,raw:string,name:string,colour:string,text:string,children:array<string>>>"
    return rows.select(
        F.col("page_id").alias("row"),
        "page_key",
        own.alias("id"),
        F.col("meta.name").alias("name"),
        F.struct("meta.page_id", "meta.revision_id", "meta.title", "url").alias("wiki"),
        "template",
        "category",
        F.col("derived_type").alias("item_type"),
        "equip_slots",
        *text("minimum_level", "required_race", "excluded_race", "required_class", "required_feat", "required_trait"),
        bound["binding"].alias("binding"),
        bound["binding_raw"].alias("binding_raw"),
        bound["exclusive"].alias("exclusive"),
        *text("material", "hardness", "durability", "base_value_cp", "weight", "upgradeable", "accepts_sentience", "umd_dc", "umd_exempt_classes"),
        _group_of(weapon).alias("weapon_stats"),
        _group_of(armor).alias("armor_stats"),
        _group_of(shield).alias("shield_stats"),
        listed("effects", effect),
        listed("customisation_hints", hint),
        "named_set",
        *text("flavor_text", "notes", "tips"),
        F.when(source.isNotNull(), F.struct(*[source[m].alias(m) for m in ("quests", "detail", "crafted_from", "raw")])).alias("source"),
        F.col("errors").alias("extraction_errors"),
    )
