"""Pages to typed items: one parse job over html, then column work on its cells and entries.

The parse is the only Python stage: it reads each page once and emits one relation of links, infobox cells and effect
entries. Everything after it, mapping, coercion, templates, outcomes, is DataFrame work keyed by page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.text import clean_text, normalize_label, page_categories, slot_slug
from ..workers import ready, spread

# Label -> (target, coercer); labels that are counted only; labels of the effects cell.
FIELDS = {
    "minimum level": ("minimum_level", "int"),
    "min level": ("minimum_level", "int"),
    "race absolutely required": ("required_race", "text"),
    "required race": ("required_race", "text"),
    "race absolutely excluded": ("excluded_race", "text"),
    "required class": ("required_class", "text"),
    "feat requirement": ("required_feat", "text"),
    "required trait": ("required_trait", "text"),
    "use magical device dc": ("umd_dc", "text"),
    "umd difficulty": ("umd_dc", "text"),
    "no umd check for": ("umd_exempt_classes", "text"),
    "binding": ("binding", "binding"),
    "bind status": ("binding", "binding"),
    "material": ("material", "text"),
    "made from": ("material", "text"),
    "hardness": ("hardness", "int"),
    "durability": ("durability", "int"),
    "base value": ("base_value_cp", "copper"),
    "weight": ("weight", "float"),
    "item type": ("item_type", "text"),
    "slot": ("slot", "text"),
    "equips to": ("slot", "text"),
    "location": ("source", "location"),
    "locations": ("source", "location"),
    "upgradeable?": ("upgradeable", "text"),
    "description": ("flavor_text", "text"),
    "flavor text": ("flavor_text", "text"),
    "notes": ("notes", "text"),
    "tips": ("tips", "text"),
    "accepts sentience?": ("accepts_sentience", "yes_no"),
    "proficiency class": ("weapon_stats.proficiency", "text"),
    "proficiency": ("weapon_stats.proficiency", "text"),
    "damage and type": ("weapon_stats.damage_dice", "damage"),
    "damage": ("weapon_stats.damage_dice", "damage"),
    "critical threat range": ("weapon_stats.critical_range", "crit"),
    "critical roll": ("weapon_stats.critical_range", "crit"),
    "weapon type": ("weapon_stats.weapon_type", "first_segment"),
    "handedness": ("weapon_stats.handedness", "text"),
    "attack mod": ("weapon_stats.attack_mod", "text"),
    "damage mod": ("weapon_stats.damage_mod", "text"),
    "armor type": ("armor_stats.armor_type", "text"),
    "armor bonus": ("armor_stats.armor_bonus", "armor_bonus"),
    "maximum dexterity bonus": ("armor_stats.max_dex_bonus", "int"),
    "maximum dex bonus": ("armor_stats.max_dex_bonus", "int"),
    "max dex bonus": ("armor_stats.max_dex_bonus", "int"),
    "armor check penalty": ("armor_stats.armor_check_penalty", "int"),
    "arcane spell failure": ("armor_stats.arcane_spell_failure", "int"),
    "shield type": ("shield_stats.shield_type", "text"),
    "shield bonus": ("shield_stats.shield_bonus", "int"),
    "damage reduction": ("shield_stats.damage_reduction", "int"),
}
IGNORED = ("target", "school", "spell resistance", "charge tier i", "charge tier ii", "charge tier iii", "charge tier iv", "charge tier v", "rarity", "augment type", "maximum stack size")
IGNORED_PATTERN = r"(?i)^f:.* shown\.(jpg|png)$"
EFFECT_LABELS = ("enchantments", "enhancements")
TYPE_BY_CATEGORY = {"Named wands": "Wand", "Rune Arms": "Rune Arm"}
SKIPPED = r"^(?:Ingredients|Raw ingredients|Consumables without a type|.+ consumables)$"

# What tells the parts of a page by class or id.
MARKS = ("mw-content-text", "mw-parser-output", "tooltip", "sortkey")

#: Text and the tag behind it, as most stand: in lower case, values in double quotes and without references; none of them starts raw text.
STEP = re.compile(r'([^<]*)<(/?)(a|b|body|dd|div|dl|dt|em|h[1-6]|head|html|i|li|ol|p|small|span|strong|sub|sup|table|tbody|td|th|thead|tr|ul)((?: [a-z-]+="[^"<>&]*")*)>')
VALUES = re.compile(' ([a-z-]+)="([^"]*)"')
VOID = frozenset(("br", "img", "hr", "input", "meta", "link"))

# What is counted since a cell began, and since a table began.
UL, LI, TOOLTIP, SORTKEY = range(4)
CELLS, ROWS = range(2)

PARSED = "page_id long, kind string, a int, b int, label string, text string, tooltip string, hrefs array<string>, in_bold array<boolean>, texts array<string>, children array<string>, tooltip_items array<string>"


class _Page(HTMLParser):
    """Rows of tables with their cells, and links, of one page. Tooltips and sort keys are set aside.

    What is open is counted as tags come and go, per cell, table and list, so no tag or text looks through the stack.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[bool, ...] | None]] = []  # tags, and which marks each has
        self.open: dict[str, int] = defaultdict(int)  # by tag
        self.bodies = self.contents = self.open_cells = 0  # open elements with the first two marks; open cells
        self.in_cell: list[list[int]] = [[0] * 4]  # since the last cell began
        self.in_table: list[list[int]] = [[0] * 2]  # since the last table began
        self.in_list: list[int] = [0]  # list items since the last list or table began
        self.links: list[dict] = []
        self.tables: list[dict] = []
        self.open_tables: list[dict] = []
        self.last: dict | None = None  # the newest cell of the innermost open table that has one
        self.has_body = self.has_content = False

    def updatepos(self, i: int, j: int) -> int:
        """Nobody asks for line numbers."""
        return j

    def parse_starttag(self, i: int) -> int:
        if (k := self._steps(i)) == i and (k := super().parse_starttag(i)) > 0 and self.cdata_elem is None:
            return self._steps(k)
        return k

    def parse_endtag(self, i: int) -> int:
        if self.cdata_elem is None and (k := self._steps(i)) > i:
            return k
        k = super().parse_endtag(i)
        return self._steps(k) if k > 0 and self.cdata_elem is None else k

    def _steps(self, i: int) -> int:
        """Reads from i on as far as tags stand as in STEP; where that ends."""
        while m := STEP.match(self.rawdata, i):
            text, slash, tag, values = m.groups()
            if text:
                self.handle_data(unescape(text) if "&" in text else text)
            if slash:
                self.handle_endtag(tag)
            elif values:
                self.handle_starttag(tag, VALUES.findall(values))
            else:
                self._start(tag, "", None)
            i = m.end()
        return i

    def _mark(self, marks: tuple[bool, ...], by: int) -> None:
        body, content, tooltip, sortkey = marks
        self.bodies += by * body
        self.contents += by * content
        self.in_cell[-1][TOOLTIP] += by * tooltip
        self.in_cell[-1][SORTKEY] += by * sortkey

    def _push(self, tag: str, name: str) -> None:
        marks = None
        if len(name) > 1 or tag in MARKS:
            marks = tuple(m in name or m == tag for m in MARKS)
            marks = marks if any(marks) else None
        self.stack.append((tag, marks))
        self.open[tag] += 1
        if marks:
            self._mark(marks, 1)
        if tag == "td" or tag == "th":
            self.open_cells += 1
            self.in_cell.append([0] * 4)
            self.in_table[-1][CELLS] += 1
        elif tag == "tr":
            self.in_table[-1][ROWS] += 1
        elif tag == "li":
            self.in_cell[-1][LI] += 1
            self.in_list[-1] += 1
        elif tag == "ul":
            self.in_cell[-1][UL] += 1
            self.in_list.append(0)
        elif tag == "ol":
            self.in_list.append(0)
        elif tag == "table":
            self.in_table.append([0] * 2)
            self.in_list.append(0)

    def _pop(self) -> None:
        tag, marks = self.stack.pop()
        self.open[tag] -= 1
        if tag == "td" or tag == "th":
            self.open_cells -= 1
            self.in_cell.pop()
            self.in_table[-1][CELLS] -= 1
        elif tag == "tr":
            self.in_table[-1][ROWS] -= 1
        elif tag == "li":
            self.in_cell[-1][LI] -= 1
            self.in_list[-1] -= 1
        elif tag == "ul":
            self.in_cell[-1][UL] -= 1
            self.in_list.pop()
        elif tag == "ol":
            self.in_list.pop()
        elif tag == "table":
            self.in_table.pop()
            self.in_list.pop()
            if self.open_tables:
                self.open_tables.pop()
                self.last = self._last_cell()
        if marks:
            self._mark(marks, -1)

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        self._start(tag, f"{at.get('class') or ''} {at.get('id') or ''}", at.get("href"))

    def _start(self, tag: str, name: str, href: str | None) -> None:
        if tag in VOID:
            return
        if tag == "td" or tag == "th" or tag == "tr":
            since = self.in_table[-1]
            while since[CELLS] or tag == "tr" and since[ROWS]:
                self._pop()
        elif tag == "li":
            while self.in_list[-1]:
                self._pop()
        self._push(tag, name)
        if len(name) > 1:
            self.has_body |= "mw-content-text" in name
            self.has_content |= "mw-parser-output" in name
        if tag == "td" or tag == "th":
            if self.open_tables and (rows := self.open_tables[-1]["rows"]):
                self.last = {"tag": tag, "parts": [], "links": [], "entries": [], "lists": 0}
                rows[-1].append(self.last)
        elif tag == "tr":
            if self.open_tables:
                self.open_tables[-1]["rows"].append([])
                self.last = self._last_cell()
        elif tag == "table":
            table = {"rows": [], "inside": self.contents > 0}
            self.tables.append(table)
            self.open_tables.append(table)
        elif tag == "a":
            if href:
                link = {"href": href, "parts": [], "bold": self.open["b"] > 0, "in_body": self.bodies > 0}
                self.links.append(link)
                for t in self.open_tables:
                    if t["rows"] and t["rows"][-1]:
                        t["rows"][-1][-1]["links"].append(link)
                if (entry := self._entry()) is not None:
                    entry["hrefs"].append(href)
        elif tag == "ul":
            if self.open_cells and self.last is not None and self.in_cell[-1][UL] < 2:
                self.last["lists"] += 1
        elif tag == "li" and self.open_cells and self.last is not None and self.last["lists"] == 1:
            if self.in_cell[-1][LI] == 1:
                self.last["entries"].append({"text": [], "tooltip": [], "tips": [], "hrefs": [], "children": []})
            elif (entry := self._entry()) is not None:
                entry["tips" if self.in_cell[-1][TOOLTIP] else "children"].append([])

    def _last_cell(self):
        """The newest cell of the innermost open table that has one."""
        return next((t["rows"][-1][-1] for t in reversed(self.open_tables) if t["rows"] and t["rows"][-1]), None)

    def _entry(self):
        cell = self.last if self.in_cell[-1][LI] and self.open_cells else None
        return cell["entries"][-1] if cell and cell["entries"] and cell["lists"] == 1 else None

    def handle_endtag(self, tag):
        if self.stack and self.stack[-1][0] == tag:
            self._pop()
        elif self.open.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if self.open["script"] or self.open["style"]:
            return
        inside, bare = self.in_cell[-1], data.strip()
        if self.open["a"] and self.links:
            self.links[-1]["parts"].append(bare)
        if inside[LI] and (entry := self._entry()) is not None:
            if inside[TOOLTIP]:
                entry["tooltip"].append(data)
            if inside[LI] > 1 and entry["tips" if inside[TOOLTIP] else "children"]:
                entry["tips" if inside[TOOLTIP] else "children"][-1].append(data)
            elif not inside[TOOLTIP]:
                entry["text"].append(data)
        if bare and self.last is not None and not inside[TOOLTIP] and not inside[SORTKEY]:
            self.last["parts"].append(bare)


def _clean(text: str) -> str:
    return " ".join(text.split())


def parse_page(page_id: int, text: str | None) -> list[dict]:
    """All relations of one page: kind link (a: position), cell (a: table, b: row) and entry (a: table, b: row, position in texts)."""
    return _relations(page_id, _read(text))


def _read(text: str | None) -> _Page:
    page = _Page()
    page.feed(text or "")
    page.close()
    return page


def _relations(page_id: int, page: _Page) -> list[dict]:
    rows = []
    said = lambda x: "".join(x["parts"])
    body = [x for x in page.links if x["in_body"]] if page.has_body else page.links
    for k, x in enumerate(body):
        rows.append({"kind": "link", "a": k, "b": 0, "label": x["href"], "text": said(x), "in_bold": [x["bold"]]})
    for t, table in enumerate(x for x in page.tables if x["inside"]):
        for r, cells in enumerate(table["rows"]):
            head, data = next((c for c in cells if c["tag"] == "th"), None), next((c for c in cells if c["tag"] == "td"), None)
            if head is None or data is None:
                continue
            join = lambda c: " ".join(x for x in c["parts"] if x)
            links = data["links"]
            rows.append({"kind": "cell", "a": t, "b": r, "label": join(head), "text": join(data), "hrefs": [x["href"] for x in links], "texts": [said(x) for x in links], "in_bold": [x["bold"] for x in links]})
            for e, entry in enumerate(data["entries"]):
                if words := _clean("".join(entry["text"])):
                    rows.append(
                        {"kind": "entry", "a": t, "b": r, "label": str(e), "text": words, "tooltip": _clean(" ".join(entry["tooltip"])) or None, "hrefs": entry["hrefs"], "children": [_clean("".join(x)) for x in entry["children"]], "tooltip_items": [_clean("".join(x)) for x in entry["tips"]]}
                    )
    return [{"page_id": page_id, **x} for x in rows]


def judged_page(page_id: int, text: str | None, head: str | None) -> list[dict]:
    """parse_page() with a row of kind page before it: label read, no_content or error with the exception in text; head in tooltip. A page that
    can't be read has this row only, and no other page suffers."""
    mark = {"page_id": page_id, "kind": "page", "a": 0, "b": 0, "tooltip": head}
    try:
        page = _read(text)
        return [mark | {"label": "read" if page.has_content else "no_content"}, *_relations(page_id, page)]
    except Exception as e:  # whatever the parser trips over is this page's outcome
        return [mark | {"label": "error", "text": f"{type(e).__name__}: {e}"}]


def parse_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", head: Column | None = None, dealt: bool = False) -> DataFrame:
    """The relation PARSED of all pages. Null html gives no rows. Write or cache it before splitting it by kind. Pages are dealt to all cores
    first, unless they lie dealt: a table of short rows is one file and one task, whatever its pages grow to.

    With head, a text for each page, every page has a row of kind page too, see judged_page().
    """
    text, numbers = pa.list_(pa.string()), pa.int32()
    schema = pa.schema(
        [("page_id", pa.int64()), ("kind", pa.string()), ("a", numbers), ("b", numbers), ("label", pa.string()), ("text", pa.string()), ("tooltip", pa.string()), ("hrefs", text), ("in_bold", pa.list_(pa.bool_())), ("texts", text), ("children", text), ("tooltip_items", text)]
    )
    judged = head is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            rows = [x for r in each for x in (judged_page(*r) if judged else parse_page(*r))]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ready(pages.sparkSession)
    given = [F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"), *([head.cast("string").alias("head")] if judged else [])]
    rows = pages.select(*given)
    return (rows if dealt else spread(rows, "page_id", "html")).mapInArrow(run, PARSED)


def page_links(parsed: DataFrame, host: str) -> DataFrame:
    """(page_id, pos, title, url) of the article links: host prefix and fragment dropped, links with a query skipped."""
    path = F.regexp_replace(F.regexp_replace("label", rf"^https?://{host.replace('.', '[.]')}", ""), "#.*$", "")
    rows = parsed.where("kind = 'link'").withColumn("_path", path).where("_path like '/page/%' and instr(_path, '?') = 0")
    title = F.replace(F.coalesce(F.try_url_decode(F.replace(F.substring("_path", 7, 1 << 20), F.lit("+"), F.lit("%2B"))), F.substring("_path", 7, 1 << 20)), F.lit("_"), F.lit(" "))
    return rows.select("page_id", F.col("a").alias("pos"), title.alias("title"), F.concat(F.lit(f"https://{host}"), "_path").alias("url"))


def pick_infobox(cells: DataFrame) -> DataFrame:
    """The cells of each page's infobox: most rows, and an effects label counts a hundred; the first table wins a tie."""
    label = normalize_label(F.col("label"))
    table = Window.partitionBy("page_id", "a")
    scored = cells.withColumn("score", F.count("*").over(table) + 100 * F.max(label.isin(*EFFECT_LABELS).cast("int")).over(table))
    best = F.max(F.struct("score", (-F.col("a")).alias("col2"))).over(Window.partitionBy("page_id"))
    return scored.withColumn("_best", best).where("score = _best.score and -a = _best.col2").drop("_best")


def picked_tables(cells: DataFrame) -> DataFrame:
    """(page_id, best, first): of each page the table that pick_infobox() picks, and its first row with an effects label, null without one; by
    sums over the labels alone, so no other column is sorted or sent."""
    effects = normalize_label(F.col("label")).isin(*EFFECT_LABELS)
    tables = cells.groupBy("page_id", "a").agg((F.count("*") + 100 * F.max(effects.cast("int"))).alias("score"), F.min(F.when(effects, F.col("b"))).alias("first"))
    return tables.groupBy("page_id").agg(F.max_by(F.struct(F.col("a").alias("best"), "first"), F.struct("score", -F.col("a"))).alias("t")).select("page_id", "t.*")


def map_rows(cells: DataFrame) -> DataFrame:
    """cells(page_id, row_pos, label, text) with the normal label, its target and coercer, and whether it is ignored or null."""
    norm = normalize_label(F.col("label"))
    rows = cells.withColumn("label", norm).withColumn("text", clean_text(F.col("text")))
    target = coerce.lookup({k: v[0] for k, v in FIELDS.items()}, F.col("label"))
    coercer = coerce.lookup({k: v[1] for k, v in FIELDS.items()}, F.col("label"))
    ignored = F.col("label").isin(*IGNORED) | F.col("label").rlike(IGNORED_PATTERN)
    return rows.withColumns({"target": target, "coercer": coercer, "ignored": ignored, "is_null": coerce.is_null_text(F.col("text"))})


def unmapped(mapped: DataFrame) -> DataFrame:
    """(page_id, label, text): rows without rule or ignore entry, text cut to 120, the last of a label."""
    rows = mapped.where(F.col("target").isNull() & ~F.col("ignored") & ~F.col("label").isin(*EFFECT_LABELS))
    return rows.groupBy("page_id", "label").agg(F.substring(F.max_by("text", "row_pos"), 1, 120).alias("text"))


def coerced(mapped: DataFrame) -> DataFrame:
    """Mapped rows that are not null texts, with value: the coerced text as JSON, null where it could not be read."""
    rows = mapped.where("target is not null and not is_null")
    value = None
    for name, f in coerce.COERCERS.items():
        typed = F.to_json(F.struct(f(F.col("text")).alias("v")))
        value = F.when(F.col("coercer") == name, typed) if value is None else value.when(F.col("coercer") == name, typed)
    # A location cell also needs its links, which came from the parse in the same row.
    links = F.col("links") if "links" in rows.columns else F.lit(None).cast("array<struct<href:string,text:string,in_bold:boolean>>")
    value = value.when(F.col("coercer") == "location", F.to_json(F.struct(coerce.location(F.col("text"), links).alias("v"))))
    return rows.withColumn("value", F.nullif(value, F.lit("{}")))


def cell_links(parsed: DataFrame) -> DataFrame:
    """Cells of parse_pages() as (page_id, table, row_pos, label, text, links)."""
    pairs = F.transform(F.arrays_zip("hrefs", "texts", "in_bold"), lambda x: F.struct(x["hrefs"].alias("href"), x["texts"].alias("text"), x["in_bold"].alias("in_bold")))
    return parsed.where("kind = 'cell'").select("page_id", F.col("a").alias("table"), F.col("b").alias("row_pos"), "label", "text", pairs.alias("links"))


def pivot_fields(values: DataFrame, targets: tuple[str, ...]) -> DataFrame:
    """One row a page, a column for each target: the value of the last row that could be read."""
    rows = values.where("value is not null")
    last = lambda t: F.max_by("value", F.when(F.col("target") == t, F.col("row_pos"))).alias(t.replace(".", "_"))
    return rows.groupBy("page_id").agg(*[last(t) for t in targets])


def extraction_errors(values: DataFrame) -> DataFrame:
    """(page_id, errors map): text that could not be read, by target; the last one wins."""
    bad = values.where("value is null").groupBy("page_id", "target").agg(F.max_by("text", "row_pos").alias("text"))
    return bad.groupBy("page_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("target", "text")))).alias("errors"))


def template_of(first: Column, labels: Column) -> Column:
    """A page's template by its first label, or by any; labels of null texts count too."""
    known = {"proficiency class": "weapon", "armor type": "armor", "shield type": "shield"}
    return F.coalesce(coerce.lookup(known, first), F.when(F.array_contains(labels, "item type"), "accessory"), F.lit("accessory_untyped"))


def detect_template(mapped: DataFrame) -> DataFrame:
    """(page_id, template) of map_rows()."""
    labels = mapped.groupBy("page_id").agg(F.min_by("label", "row_pos").alias("first"), F.collect_set("label").alias("labels"))
    return labels.select("page_id", template_of(F.col("first"), F.col("labels")).alias("template"))


def split_parts(text: Column, separator: str) -> Column:
    """Parts of a text, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


def derive(rows: DataFrame) -> DataFrame:
    """category, item_type and equip_slots of rows(template, item_type, slot, weapon_type, armor_type, shield_type, categories)."""
    parts = split_parts(F.col("item_type"), " / ")
    known = F.lower(F.get(parts, F.lit(0)))
    category = F.when(F.col("template").isin("weapon", "armor", "shield"), F.col("template")).when(
        (F.col("template") == "accessory") & known.isin("jewelry", "clothing", "weapon", "armor", "shield"), known
    )
    by_category = None
    for name, kind in TYPE_BY_CATEGORY.items():
        test = F.array_contains("categories", name)
        by_category = F.when(test, kind) if by_category is None else by_category.when(test, kind)
    item_type = (
        F.when(F.col("template") == "weapon", F.col("weapon_type"))
        .when(F.col("template") == "armor", F.col("armor_type"))
        .when(F.col("template") == "shield", F.col("shield_type"))
        .when(F.col("template") == "accessory", F.get(parts, F.lit(1)))
        .otherwise(F.col("item_type"))
    )
    own = F.when(F.col("template") == "accessory_untyped", by_category)
    fixed = {"weapon": "main_hand", "armor": "body", "shield": "off_hand"}
    slots = F.when(F.col("template") == "accessory", F.transform(split_parts(F.col("slot"), ",| or "), slot_slug))
    slots = slots.when(F.col("template").isin(*fixed), F.array(coerce.lookup(fixed, F.col("template")))).otherwise(F.array().cast("array<string>"))
    return rows.withColumns({"category": F.coalesce(category, F.lit("other")), "derived_type": F.coalesce(item_type, own), "equip_slots": slots})


def page_outcome(pages: DataFrame, infobox: DataFrame) -> DataFrame:
    """(page_id, outcome): extracted with an infobox, skipped without one in a category of ingredients or consumables, else failed."""
    has = infobox.select("page_id").distinct().withColumn("_has", F.lit(True))
    skip = F.exists(page_categories(F.col("html")), lambda c: c.rlike(SKIPPED))
    outcome = F.when(F.col("_has"), "extracted").when(skip, "skipped").otherwise("failed")
    return pages.join(has, "page_id", "left").select("page_id", outcome.alias("outcome"))
