"""Entry classification by ordered rules: the first rule whose guards and pattern match decides.

entries(page_id, entry_pos, text, tooltip, hrefs, children, tooltip_items, note). The rule's number is found in one
CASE expression, captures by the number in a second projection, so every pattern is tried at most twice and nothing
leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import lookup
from ..functions.text import clean_text


@dataclass(frozen=True)
class Rule:
    """captures names the groups of the pattern in order; guard is children, tooltip_items or nothing."""

    id: str
    kind: str
    pattern: str
    captures: tuple[str, ...]
    value_kind: str | None = None
    hint: str | None = None
    guard: str | None = None
    options: dict = field(default_factory=dict)


_NUMBER = r"(\d+(?:\.\d+)?)"
ITEM = r"^(\d+) Pieces? Equipped:\s*(.+)$"
# The rules in order of precedence, the words that may stand before a bracketed percentage, numerals.
PERCENT_WORDS = "Alchemical|Artifact|Competence|Deflection|Dodge|Enhancement|Equipment|Exceptional|Implement|Insight|Primal|Profane|Resistance|Shield|Vitality"
RULES = (
    Rule("unique_system", "hint", r"^(.+?)(?:\s+(?:One of the following|Tier \d).*)?$", ("name",), hint="unique_system", guard="children"),
    Rule("set_membership", "set", r"^(.+)$", ("name",), guard="tooltip_items"),
    Rule("set_bonus", "set_bonus", ITEM, ("pieces", "text")),
    Rule("augment_slot", "hint", r"^([A-Za-z]+) Augment Slot\b\s*(.*)$", ("colour", "text"), hint="augment_slot"),
    Rule("augment_upgrade", "hint", r"^Upgradeable\s*-\s*(.+)$", ("name",), hint="augment_upgrade"),
    Rule("mythic_reaper", "hint", r"^(Mythic|Reaper)\b\s*(.*)$", ("hint", "text")),
    Rule("clicky", "effect", r"^(.+?)\s+[—-]\s+(\d+) Charges?(?:\s*\(Recharged/Day:\s*(\d+)\))?$", ("name", "charges", "recharge")),
    Rule("alignment_dr", "effect", r"^DR\s+(\d+)\s*/\s*([A-Za-z]+)$", ("value", "bypass"), "flat"),
    Rule("bonus_name_paren_percent", "effect", rf"^({PERCENT_WORDS})\s+(.+?)\s*\(\+(\d+)(%)\)$", ("btype", "name", "value", "pct"), "percent"),
    Rule("bonus_to", "effect", rf"^\+{_NUMBER}(%)?\s+([A-Za-z]+) bonus to (.+)$", ("value", "pct", "btype", "name"), "flat"),
    Rule("tier_colon", "effect", r"^(.+?)\s*:\s*([IVX]{1,5})$", ("name", "tier"), "tier"),
    Rule("value_first", "effect", rf"^\+{_NUMBER}(%)?\s+([A-Za-z].*)$", ("value", "pct", "name"), "flat"),
    Rule("signed_suffix", "effect", rf"^(.+?)\s*([+-]){_NUMBER}(%)?$", ("name", "sign", "value", "pct"), "flat"),
    Rule("adds_value", "effect", rf"^Adds\s+\+{_NUMBER}\s+(.+)$", ("value", "name"), "flat"),
    Rule("percent_suffix", "effect", r"^(.+?)\s+(\d+)%$", ("name", "value"), "percent"),
    Rule("roman_suffix", "effect", r"^(.+?)\s+([IVX]{1,5})$", ("name", "tier"), "tier"),
    Rule("number_suffix", "effect", r"^(.+?)\s+(\d+)$", ("name", "value"), "number"),
    Rule("plain_effect", "effect", r"^(.+)$", ("name",)),
)
FALLBACK = "plain_effect"
ROMAN = dict(zip("I II III IV V VI VII VIII IX X XI XII XIII XIV XV".split(), range(1, 16), strict=True))
LINK_BONUS = r"/page/([A-Za-z]+)_bonus$"
TEXT_BONUS = r"\b([A-Z][a-z]+) [Bb]onus\b"
TOOLTIP_BONUS = r"[+-]?\d+%?\s+([A-Z][a-z]+) [Bb]onus\b"
TIERED = r"^(?:Lesser|Greater|Superior)\s"
TOOLTIP_VALUE = rf"(?:([+-])|\bby\s+){_NUMBER}(%)?"
NOTE = r"^(.*?)\s*\(\s*(Bug:[^()]*)\)\s*$"


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def split_note(entries: DataFrame) -> DataFrame:
    """entries with a bracketed bug note at the end of the text moved to note."""
    has = F.col("text").rlike(NOTE)
    return entries.withColumn("note", F.when(has, F.trim(F.regexp_extract("text", NOTE, 2)))).withColumn("text", F.when(has, F.regexp_extract("text", NOTE, 1)).otherwise(F.col("text")))


def has_children() -> Column:
    return F.coalesce(F.size("children"), F.lit(0)) > 0


def tooltip_items_match() -> Column:
    return F.coalesce(F.exists("tooltip_items", lambda x: x.rlike(r"^\d+ Pieces? Equipped:")), F.lit(False))


def first_match(entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """entries with the id and kind of the first rule that matches; null if none does."""
    found = F
    for rule in rules:
        test = F.col("text").rlike(rule.pattern)
        guard = {"children": has_children(), "tooltip_items": tooltip_items_match()}.get(rule.guard)
        found = found.when(test if guard is None else guard & test, rule.id)
    kinds = {r.id: r.kind for r in rules}
    return entries.withColumn("rule", found).withColumn("kind", lookup(kinds, F.col("rule")))


def captures(matched: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """first_match() rows with a column g_<name> for every capture; null where the rule has none."""
    names = sorted({c for r in rules for c in r.captures})
    columns = {}
    for name in names:
        value = None
        for rule in rules:
            if name in rule.captures:
                part = _group(F.col("text"), rule.pattern, rule.captures.index(name) + 1)
                value = F.when(F.col("rule") == rule.id, part) if value is None else value.when(F.col("rule") == rule.id, part)
        columns[f"g_{name}"] = value
    return matched.withColumns(columns).withColumn("g_hint", F.lower("g_hint"))


def roman_value(numeral: Column) -> Column:
    return lookup(ROMAN, numeral)


def tiered_value(tooltip: Column) -> Column:
    """struct(value, percent) of a tooltip that holds exactly one number, signed or after "by"; else null."""
    one = F.size(F.regexp_extract_all(tooltip, F.lit(_NUMBER), F.lit(1))) == 1
    number = _group(tooltip, TOOLTIP_VALUE, 2).try_cast("double")
    signed = F.when(_group(tooltip, TOOLTIP_VALUE, 1) == "-", -number).otherwise(number)
    return F.when(one & tooltip.rlike(TOOLTIP_VALUE), F.struct(signed.alias("value"), _group(tooltip, TOOLTIP_VALUE, 3).isNotNull().alias("percent")))


def bonus_type(own: Column, hrefs: Column, text: Column | None, tooltip: Column, tiered: Column) -> Column:
    """The entry's bonus type: its own capture, the first link to one, the text (set rows), the first in the tooltip, which for
    tiered names counts only if all in it are the same."""
    linked = F.get(F.filter(F.transform(hrefs, lambda h: _group(h, LINK_BONUS, 1)), lambda x: x.isNotNull()), F.lit(0))
    said = F.transform(F.regexp_extract_all(tooltip, F.lit(TOOLTIP_BONUS), F.lit(1)), lambda x: F.lower(x))
    from_tooltip = F.when(~tiered | (F.size(F.array_distinct(said)) == 1), F.get(said, F.lit(0)))
    from_text = F.lit(None).cast("string") if text is None else F.lower(_group(text, TEXT_BONUS, 1))
    return F.coalesce(F.lower(own), F.lower(linked), from_text, from_tooltip)


def effects(captured: DataFrame, *more: str) -> DataFrame:
    """The effect rows: name, value, value_is_float, value_kind, bonus_type, charges, recharge_per_day, note, and more columns."""
    rows = captured.where("kind = 'effect'")
    kind = lookup({r.id: r.value_kind for r in RULES if r.value_kind}, F.col("rule"))
    raw = F.col("g_value").try_cast("double")
    signed = F.when(F.col("g_sign") == "-", -raw).otherwise(raw)
    value = F.coalesce(roman_value(F.col("g_tier")).cast("double"), signed)
    name = clean_text(F.when(F.col("rule") == "alignment_dr", F.concat(F.lit("DR/"), "g_bypass")).otherwise(F.col("g_name")))
    rows = rows.withColumn("name", name).withColumn("_tiered", F.col("name").rlike(TIERED))
    own = F.when(F.col("g_tier").isNotNull(), "tier").when(F.col("g_pct").isNotNull(), "percent").otherwise(kind)
    rows = rows.withColumns({"_value": value, "_kind": own, "_tip": F.when(value.isNull() & F.col("_tiered"), tiered_value(F.col("tooltip")))})
    total = F.coalesce("_value", "_tip.value")
    return rows.select(
        "page_id",
        "entry_pos",
        "rule",
        "name",
        total.alias("value"),
        F.coalesce(F.contains("g_value", F.lit(".")), F.lit(False)).alias("value_is_float"),
        F.when(F.col("_value").isNotNull(), F.col("_kind")).when(F.col("_tip").isNotNull(), F.when(F.col("_tip.percent"), "percent").otherwise("flat")).alias("value_kind"),
        bonus_type(F.col("g_btype"), F.col("hrefs"), None, F.col("tooltip"), F.col("_tiered")).alias("bonus_type"),
        F.col("g_charges").try_cast("bigint").alias("charges"),
        F.col("g_recharge").try_cast("bigint").alias("recharge_per_day"),
        "note",
        *more,
    )


def hints(captured: DataFrame) -> DataFrame:
    """The customisation hints: kind, raw text, captures, children."""
    kind = F.coalesce(lookup({r.id: r.hint for r in RULES if r.hint}, F.col("rule")), F.col("g_hint"))
    return captured.where("kind = 'hint'").select("page_id", "entry_pos", kind.alias("hint_kind"), F.col("text").alias("raw"), F.col("g_name").alias("name"), F.col("g_colour").alias("colour"), F.col("g_text").alias("hint_text"), "children")


def set_bonuses(captured: DataFrame) -> DataFrame:
    """(page_id, entry_pos, item_pos, from_set, pieces, bonus_text, bonus_type): bonuses in set rows' tooltips and bare ones."""
    items = captured.where("kind = 'set'").select("page_id", "entry_pos", "hrefs", "tooltip", F.posexplode("tooltip_items").alias("item_pos", "item")).where(F.col("item").rlike(ITEM))
    plain = F.lit(False)
    typed = lambda text: bonus_type(F.lit(None).cast("string"), F.col("hrefs"), text, F.col("tooltip"), plain)
    text = F.regexp_extract("item", ITEM, 2)
    own = items.select("page_id", "entry_pos", "item_pos", F.lit(True).alias("from_set"), F.regexp_extract("item", ITEM, 1).try_cast("bigint").alias("pieces"), text.alias("bonus_text"), typed(text).alias("bonus_type"))
    bare = captured.where("kind = 'set_bonus'").select("page_id", "entry_pos", F.lit(0).alias("item_pos"), F.lit(False).alias("from_set"), F.col("g_pieces").try_cast("bigint").alias("pieces"), F.col("g_text").alias("bonus_text"), typed(F.col("g_text")).alias("bonus_type"))
    return own.unionByName(bare)


def set_merge(captured: DataFrame) -> DataFrame:
    """(page_id, name, bonuses) of pages with set rows: the last set row's name; its own bonuses, then the bare ones."""
    names = captured.where("kind = 'set'").groupBy("page_id").agg(F.max_by("g_name", "entry_pos").alias("name"))
    rows = set_bonuses(captured).select("page_id", F.struct((~F.col("from_set")).alias("bare"), "entry_pos", "item_pos", "pieces", "bonus_text", "bonus_type").alias("b"))
    merged = rows.groupBy("page_id").agg(F.array_sort(F.collect_list("b")).alias("b"))
    bonus = F.transform("b", lambda x: F.concat_ws("|", x["pieces"].cast("string"), x["bonus_text"], F.coalesce(x["bonus_type"], F.lit("-"))))
    return names.join(merged, "page_id", "full_outer").select("page_id", "name", F.coalesce(bonus, F.array().cast("array<string>")).alias("bonuses"))


def unclassified(matched: DataFrame) -> DataFrame:
    """(page_id, texts): what no rule matched, or the last one with a digit in it; repeats stay, in order."""
    odd = matched.where((F.col("rule").isNull()) | ((F.col("rule") == FALLBACK) & F.col("text").rlike(r"\d")))
    return odd.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("entry_pos", "text"))), lambda x: x["text"]).alias("texts"))


def rule_hits(matched: DataFrame) -> DataFrame:
    return matched.where("rule is not null").groupBy("page_id", "rule").agg(F.count("*").alias("n"))


def entry_warnings(matched: DataFrame) -> DataFrame:
    """(page_id, warning): bug notes on other rows than effects, and set bonuses without a set."""
    notes = matched.where("note is not null and kind <> 'effect'").select("page_id", F.concat(F.lit("note on "), "kind").alias("warning"))
    sets = matched.groupBy("page_id").agg(F.count_if(F.col("kind") == "set").alias("s"), F.count_if(F.col("kind") == "set_bonus").alias("b"))
    return notes.union(sets.where("s = 0 and b > 0").select("page_id", F.lit("set without a name").alias("warning")))


def rank_rules(entries: DataFrame, rules: DataFrame) -> DataFrame:
    """The same decision for rule sets given as a table(pos, rule, pattern): a theta join and the lowest position."""
    return entries.join(rules, F.expr("text rlike pattern")).groupBy("page_id", "entry_pos").agg(F.min_by("rule", "pos").alias("rule"))
