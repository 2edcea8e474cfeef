"""Edge cases of column functions, rules, snapshots and streams."""

from __future__ import annotations

import random
import re
import time
from datetime import datetime, timedelta
from html.parser import HTMLParser
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import coerce, text
from millrace.operators import analysis, catalog, entries, infobox, ledger, robots
from millrace.plans import core_queries
from millrace.sources import tables
from millrace.streaming import guard

HOST = "wiki.example.org"


def values(spark, f, *inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.v for r in rows.select("i", f(F.col("x")).alias("v")).orderBy("i").collect()]


def test_urls(spark):
    url = f"https://{HOST}/page/"
    got = values(spark, lambda c: text.page_title(c, HOST), url + "A_b%27c", url + "A+b", url + "100%_x", url + "special:X", url, url + "A?x=1", "https://other.org/page/A", None)
    assert got == ["A b'c", "A+b", "100% x", None, None, None, None, None]
    assert values(spark, text.page_key, url + "A%20b", url + "A_b") == ["A_b", "A_b"]
    assert values(spark, text.update_slug, "update 007 named items", "Update_x", None) == ["update-7", "unknown", "unknown"]
    assert values(spark, text.file_slug, "Él Big   Thing!", "***", None, "a" * 59 + " bc") == ["l-big-thing", "item", "item", "a" * 59]


def test_labels(spark):
    assert values(spark, text.normalize_label, " Minimum  Level : ", "A::", None) == ["minimum level", "a", None]


@pytest.mark.parametrize(
    ("name", "given", "wanted"),
    [
        ("int", ["a -3 b", "none", None], [-3, None, None]),
        ("float", ["1.5 lbs", "x"], [1.5, None]),
        ("yes_no", ["YES", "False", "?"], [True, False, None]),
        ("copper", ["1,200 pp 3 gp", "5 zp"], [1_200_300, None]),
    ],
)
def test_coercers(spark, name, given, wanted):
    assert values(spark, coerce.COERCERS[name], *given) == wanted


def test_damage(spark):
    full, bare, none = values(spark, coerce.damage, "5.20[1d8-2] + 15 Pierce, Odd", "2d6", "big")
    assert (full.multiplier, full.dice, full.bonus, full.enhancement, full.types) == (5.2, "1d8", -2, 15, ["Piercing", "Odd"])
    assert (bare.multiplier, bare.dice, bare.bonus, bare.enhancement, bare.types) == (1.0, "2d6", 0, 0, [])
    assert none is None


@pytest.mark.parametrize(
    ("given", "rule"),
    [("Glow +9", "signed_suffix"), ("Glow IV", "roman_suffix"), ("Quiet", "plain_effect"), ("DR 6/Light", "alignment_dr"), ("DR 6", "number_suffix"), ("Guard (+10%)", "plain_effect"), ("Insight Guard (+10%)", "bonus_name_paren_percent"), ("+3% Luck bonus to x", "bonus_to"), ("x — 3 Charges", "clicky"), ("", None)],
)
def test_rules(spark, given, rule):
    rows = spark.createDataFrame([(1, 0, given, None, [], [], [], None)], "page_id long, entry_pos long, text string, tooltip string, hrefs array<string>, children array<string>, tooltip_items array<string>, note string")
    assert entries.first_match(rows).collect()[0].rule == rule
    table = spark.createDataFrame([(k, r.id, r.pattern) for k, r in enumerate(entries.RULES) if not r.guard], "pos int, rule string, pattern string")
    ranked = [r.rule for r in entries.rank_rules(rows, table).collect()]
    assert ranked == ([rule] if rule else [])


def test_parse_nested_tables():
    page = """<div class="mw-parser-output"><table><tr><th>A</th><td>x<table><tr><th>B</th><td>y</td></tr></table>z</td></tr><tr><th>C<td>open <b><a href="/page/Q">q</a></b></table></div>"""
    cells = [(r["a"], r["label"], r["text"]) for r in infobox.parse_page(1, page) if r["kind"] == "cell"]
    assert (0, "A", "x z") in cells and (1, "B", "y") in cells and (0, "C", "open q") in cells
    assert infobox.parse_page(1, None) == []


def test_minted_ids_are_stable(spark):
    a, b = (spark.range(50).select(catalog.minted_id(F.col("id")).alias("x")).repartition(n).collect() for n in (1, 7))
    assert sorted(a) == sorted(b) and len({r.x for r in a}) == 50
    assert spark.createDataFrame(a).where(~F.col("x").rlike(catalog.UUID4)).count() == 0


def test_enqueue_twice_is_a_no_op(spark):
    queue = spark.createDataFrame([(1, "a", "p", "complete", 0)], "id long, item_name string, update_page string, status string, retry_count int")
    links = spark.createDataFrame([("a", "p", "w", 1), ("b", "p", "w2", 3), ("b", "p", "w1", 2)], "item_name string, update_page string, wiki_url string, pos long")
    new = ledger.enqueue(queue, links)
    assert [(r.item_name, r.wiki_url) for r in new.collect()] == [("b", "w1")]
    both = queue.unionByName(new.select("item_name", "update_page", "status", "retry_count"), allowMissingColumns=True)
    assert ledger.enqueue(both, links).count() == 0


def test_links_of_one_place_go_by_the_order_in_which_they_are_read(spark, tmp_path):
    given = [(f"i{k}", "p", f"w{(k * 7919 + n * 104729) % 1000:03}", 1) for n in range(4) for k in range(200)]
    columns = "item_name string, update_page string, wiki_url string, pos long"
    spark.createDataFrame(given, columns).coalesce(1).write.parquet(f"{tmp_path}/links")
    first = {}
    for item, _, url, _ in given:
        first.setdefault(item, url)
    queue = spark.createDataFrame([], "id long, item_name string, update_page string")
    found = ledger.enqueue(queue, spark.read.parquet(f"{tmp_path}/links"))
    assert {r.item_name: r.wiki_url for r in found.collect()} == first
    # Tasks fetch rows in any order, so the window's own order must leave no tie open.
    assert re.search(r"windowspecdefinition\(item_name.*pos#\d+L? ASC[^,]*, _read#\d+L? ASC", found._jdf.queryExecution().analyzed().toString())


def brute_policy(text: dict[str, list[str]], url: str | None, token: str) -> tuple[bool, float | None]:
    """Whether a URL is allowed, and its host's delay, by reading the host's lines one after another."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)(\?[^#]+)?", url or "")
    host, target = (m[1].lower(), (m[2] or "/") + (m[3] or "")) if m else ("", None)
    groups, closed = [], True
    for line in text.get(host, []):
        key, colon, value = (x.strip() for x in line.split("#")[0].strip().partition(":"))
        if key.lower() == "user-agent" and colon:
            if closed:
                groups.append({"agents": [], "rules": [], "delay": None})
            closed = False
            groups[-1]["agents"].append(value.lower())
        elif key.lower() in ("allow", "disallow", "crawl-delay") and groups:
            closed = True
            if key.lower() == "crawl-delay":
                groups[-1]["delay"] = float(value) if re.fullmatch(r"[\d.]+", value) else groups[-1]["delay"]
            elif value:
                groups[-1]["rules"].append((value, key.lower() == "allow"))
    mine = [g for g in groups if any(a != "*" and a in token for a in g["agents"])] or [g for g in groups if "*" in g["agents"]]
    fits = [(len(p), a) for g in mine for p, a in g["rules"] if target is not None and re.match(".*".join(map(re.escape, p.removesuffix("$").split("*"))) + ("$" if p.endswith("$") else ""), target)]
    return target == "/robots.txt" or max(fits, default=(0, True))[1], max((g["delay"] for g in mine if g["delay"] is not None), default=None)


def test_robots(spark):
    draw = random.Random(8)
    pieces = ["/", "a", "b", "*", "$", "?", ".", "/a/"]
    rule = lambda: f"{draw.choice(['Allow', 'disallow', 'Disallow '])}: {''.join(draw.choices(pieces, k=draw.randrange(5)))}"
    other = lambda: draw.choice(["User-agent: *", "user-agent: Bot", "User-Agent: x", "Crawl-delay: 5", "Crawl-delay: soon", "Crawl-delay: 2.5 # s", "# note", "", "odd"])
    text = {f"h{k}": [draw.choice((rule, rule, other))() for _ in range(draw.randrange(14))] for k in range(40)}
    text["h0"] = ["User-agent: *", "Disallow: /a*b$", "Allow: /a", "Disallow: /a", "Crawl-delay: 5", "Crawl-delay: soon"]
    lines = spark.createDataFrame([(h, i, x) for h, each in text.items() for i, x in enumerate(each)], "host string, pos int, line string")
    urls = [None, "", "odd", "https://H0/axb", "https://h0/axbc", "https://h0", "https://h0/robots.txt", "https://h0/axb", "https://none/a"]
    urls += [f"https://h{draw.randrange(40)}/{''.join(draw.choices(pieces[:3] + pieces[5:], k=draw.randrange(6)))}" for _ in range(300)]
    rules = robots.rules_for(robots.robots_rules(lines), "mybot")
    got = robots.url_policy(spark.createDataFrame(list(enumerate(urls)), "i int, url string"), rules)
    assert {r.i: r.allowed for r in got.collect()} == {i: brute_policy(text, u, "mybot")[0] for i, u in enumerate(urls)}
    delays = {h: d for h in text if (d := brute_policy(text, f"https://{h}/", "mybot")[1]) is not None}
    assert {r.host: r.crawl_delay for r in robots.crawl_delays(rules).collect()} == delays and delays["h0"] == 5.0


def guard_stops(rows: list[tuple]) -> dict:
    """run -> (seq, reason) of rows (run, seq, kind, at), one at a time in order of time and place."""
    found, state = {}, {}
    for run, seq, kind, at in sorted((r for r in rows if None not in r), key=lambda r: (r[3], r[1])):
        streak, processed, failed = state.get(run, (0, 0, 0))
        streak = streak + 1 if kind == "throttle" else 0 if kind in ("stored", "plain") else streak
        processed, failed = processed + (kind in ("completed", "failed", "skipped")), failed + (kind == "failed")
        state[run] = (streak, processed, failed)
        if streak >= 3 or (failed >= 3 and failed * 10 > processed):
            found.setdefault(run, (seq, "throttled" if streak >= 3 else "failures"))
    return found


GUARD = "run string, seq long, kind string, at timestamp"


def guarded(spark, folder, batches: list[list[tuple]], delay: str, slot_seconds: int) -> tuple[dict, list]:
    """What the guard gives over micro-batches in this order, and the progress of the last run; the stream is started again half-way."""
    dropped = 0
    for half in (batches[: len(batches) // 2], batches[len(batches) // 2 :]):
        for batch in half:
            spark.createDataFrame(batch, GUARD).coalesce(1).write.mode("append").parquet(f"{folder}/log")
            time.sleep(0.01)  # files are read in the order of their times
        stream = spark.readStream.schema(GUARD).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
        query = guard.stream_guard(stream, delay, slot_seconds).writeStream.format("parquet").option("path", f"{folder}/stops").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    rows = spark.read.schema(guard.OUTPUT).parquet(f"{folder}/stops").collect()
    assert len(rows) == len({r.run for r in rows})
    return {r.run: (r.seq, r.reason) for r in rows}, dropped


def test_stream_guard_counts_late_rows_in_order(spark, tmp_path):
    draw, begun = random.Random(2), datetime(2024, 1, 1)
    kinds = ("throttle", "stored", "plain", "browser", *["completed"] * 12, "skipped", "failed")
    rows = [(f"r{draw.randrange(12)}", i, draw.choice(kinds if i % 12 else kinds[:3]), begun + timedelta(seconds=10 * (i // 2))) for i in range(1500)]
    rows += [("storm", i, "throttle", begun + timedelta(seconds=5 * i)) for i in range(300, 900)]
    rows += [(None, 1, "throttle", begun), ("gaps", None, "throttle", begun), ("gaps", 2, None, begun), ("gaps", 3, "throttle", None), ("gaps", 4, "throttle", begun)]
    # A row comes up to 15 minutes after its time, so seq falls within and between micro-batches.
    rows.sort(key=lambda r: (r[3] or begun) + timedelta(seconds=draw.randrange(900)))
    batches = [rows[at : at + 350] for at in range(0, len(rows), 350)] + [[(None, None, None, begun + timedelta(days=1))]]
    got, dropped = guarded(spark, tmp_path, batches, "15 minutes", 120)
    assert got == guard_stops(rows) and dropped == 0 and len(got) > 6 and {x[1] for x in got.values()} == {"throttled", "failures"}


def test_stream_guard_tells_of_rows_behind_the_delay(spark, tmp_path):
    begun = datetime(2024, 1, 1)
    at = lambda minutes: begun + timedelta(minutes=minutes)
    batches = [
        [("a", 1, "throttle", at(0)), ("a", 2, "throttle", at(1)), ("b", 5, "throttle", at(60))],
        [("b", 4, "throttle", at(55)), ("b", 3, "throttle", at(52))],
        [("a", 3, "throttle", at(2)), ("b", 6, "throttle", at(70))],  # 58 minutes behind: not counted
        [(None, None, None, at(600))],
    ]
    got, dropped = guarded(spark, tmp_path, batches, "10 minutes", 60)
    assert got == {"b": (5, "throttled")} and dropped == 1


class StateInMemory:
    """The state of one run with its timers, which counts the calls to it."""

    def __init__(self) -> None:
        self.value, self.slots, self.timers, self.calls = None, {}, set(), 0

    def _call(self, result=None):
        self.calls += 1
        return result

    def getValueState(self, *_):  # noqa: N802
        return SimpleNamespace(get=lambda: self._call(self.value), update=lambda x: self._call(setattr(self, "value", x)))

    def getMapState(self, *_):  # noqa: N802
        there = self.slots
        return SimpleNamespace(
            containsKey=lambda k: self._call(k in there), getValue=lambda k: self._call(there[k]), updateValue=lambda k, v: self._call(there.update({k: v})),
            removeKey=lambda k: self._call(there.pop(k)), keys=lambda: self._call(iter(list(there))), clear=lambda: self._call(there.clear()),
        )

    def registerTimer(self, at):  # noqa: N802
        self._call(self.timers.add(at))


def guard_in_memory(rows: list[tuple], batches: int, delay_s: int, slot_s: int) -> tuple[list, StateInMemory]:
    """Stops of one run's rows (run, seq, kind, second) in this order, by the guard's own calls, and its state."""
    state, one, watermark, stops = StateInMemory(), guard._Guard(slot_s * 1_000_000), 0, []
    one.init(state)
    size = -(-len(rows) // batches)
    for part in [rows[at : at + size] for at in range(0, len(rows), size)] + [[]]:
        new = pd.DataFrame([(r[3] * 1_000_000, r[1], guard.KINDS.get(r[2], -1)) for r in part], columns=["us", "seq", "code"])
        if len(new):
            list(one.handleInputRows(("r",), iter([new[:7], new[7:]]), None))
        watermark = max(watermark, max((r[3] for r in part), default=10**7) - delay_s)
        for at in sorted(x for x in state.timers if x <= watermark * 1000):
            state.timers.remove(at)
            found = one.handleExpiredTimer(("r",), SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w * 1000), None)
            stops += [tuple(x) for f in found for x in f.itertuples(index=False)]
    return stops, state


@pytest.mark.parametrize("held", [3, 40, 1 << 16])
def test_guard_gives_the_same_however_rows_wait(monkeypatch, held):
    monkeypatch.setattr(guard, "HELD", held)
    draw, stopped = random.Random(held), 0
    for _ in range(200):
        kinds = ["throttle", "stored", "plain", "browser", *["completed"] * draw.choice((1, 12)), "skipped", "failed"]
        rows = [("r", i, draw.choice(kinds), 10 * (i // 2)) for i in range(draw.randrange(1, 150))]
        rows.sort(key=lambda r: r[3] + draw.randrange(300))
        stops, state = guard_in_memory(rows, draw.randrange(1, 7), 300, draw.choice((7, 60, 5000)))
        want = guard_stops(rows).get("r")
        assert stops == ([("r", *want)] if want else []) and not state.slots
        stopped += want is not None
    assert 50 < stopped < 200 and not state.value[6]


def test_guard_calls_do_not_grow_with_slots():
    for n in (100, 1000):
        _, state = guard_in_memory([("r", i, "completed", 60 * i) for i in range(n)], 4, 300, 60)
        assert state.calls <= 8 * 5


def test_first_stop_equals_one_row_at_a_time():
    draw = random.Random(8)
    for _ in range(300):
        kinds = [draw.choice(list(guard.KINDS)) for _ in range(draw.randrange(1, 40))]
        rows = [("r", i, k, draw.randrange(20)) for i, k in enumerate(kinds)]
        ordered = sorted(rows, key=lambda r: (r[3], r[1]))
        cut = draw.randrange(len(rows) + 1)
        stop, state = None, (0, 0, 0)
        for part in (ordered[:cut], ordered[cut:]):
            if part and stop is None:
                draw.shuffle(part)
                stop, state = guard.first_stop(np.array([(r[3], r[1], guard.KINDS[r[2]]) for r in part], guard.ROW), *state)
        assert guard_stops(rows).get("r") == stop


@pytest.mark.parametrize("name", ["chk_canonical", "chk_registered"])
def test_heavy_work_on_a_small_file_runs_on_all_cores(spark, tmp_path, name):
    """The rows of one small file, whose texts are long, are checked by more than one task."""
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    cores = spark.sparkContext.defaultParallelism
    plan = core_queries()[0][name](spark, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions() == 1 and len(plan.inputFiles()) >= cores
    told = plan.withColumn("task", F.spark_partition_id())
    assert told.select("task").distinct().count() > 1


def test_segmented_scans_equal_one_pass(spark):
    draw = random.Random(21)
    kinds = ("throttle", "throttle", "stored", "plain", "browser", "completed", "completed", "completed", "completed", "failed", "skipped", "challenge")
    rows = [("one", i, draw.choice(kinds if i > 900 else kinds[3:9])) for i in range(3000)]
    rows += [(f"r{draw.randrange(60)}", i, draw.choice(kinds)) for i in range(1500)]
    want: dict = {"throttle": {}, "rate": {}, "switch": {}}
    for run in {r[0] for r in rows}:
        streak = processed = failed = row = challenges = fetches = 0
        for _, seq, kind in sorted(r for r in rows if r[0] == run):
            streak = streak + 1 if kind == "throttle" else 0 if kind in ("stored", "plain") else streak
            processed += kind in ("completed", "failed", "skipped")
            failed += kind == "failed"
            if kind in ("challenge", "plain", "stored"):
                row, fetches, challenges = (row + 1 if kind == "challenge" else 0), fetches + 1, challenges + (kind == "challenge")
            for name, stop in (("throttle", streak >= 3), ("rate", failed >= 3 and failed * 10 > processed), ("switch", row >= 3 or (fetches >= 10 and challenges > 0.2 * fetches))):
                if stop:
                    want[name].setdefault(run, seq)
    log = spark.createDataFrame(rows, "run string, seq long, kind string").repartition(3)
    read = lambda found: {r.run: r.seq for r in found.collect()}
    assert {"throttle": read(analysis.throttle_streak(log)), "rate": read(analysis.failure_rate_stop(log)), "switch": read(analysis.challenge_switch(log))} == want
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["count"] for r in analysis.segmented(log.where("run = 'one'"), *kinds).groupBy(analysis.SEGMENT).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 3000 and max(sizes) <= 0.1 * 3000  # one run of all rows is many segments
    assert read(analysis.throttle_streak(log.where("false"))) == {}


def test_large_text_files_are_read_in_splits(spark, tmp_path):
    draw = random.Random(22)
    lines = {n: [f"{i} " + "é" * draw.randrange(30) for i in range(k)] for n, k in (("a", 20_000), ("b", 3), ("c", 7000))}
    for n, each in lines.items():
        (tmp_path / n).write_text("\n".join(each) + ("\n" if n != "b" else ""), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = tables.text_lines(spark, f"file://{tmp_path}")
        assert read.rdd.getNumPartitions() > 1 and spark.read.text(f"file://{tmp_path}").rdd.getNumPartitions() > 8
        got: dict = {}
        for r in read.collect():
            got.setdefault(r.path.rsplit("/", 1)[1], {})[r.pos] = r.line
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {n: [x[i] for i in range(len(x))] for n, x in got.items()} == lines


def test_listings_come_from_the_seed_or_not_at_all(spark):
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "page_name string")
    read = lambda found, seed: sorted(r.page_name for r in ledger.list_or_seed(found, seed).collect())
    assert read(frame("a", "b"), frame("s")) == read(frame("a", "b"), frame()) == ["a", "b"]
    assert read(frame(), frame("s", "t")) == ["s", "t"]
    with pytest.raises(Exception, match="neither the index nor the seed"):  # noqa: B017
        read(frame(), frame())


def test_registry_defects_with_many_lines_without_keys(spark):
    good = '{{"id": "{0:08d}-0000-4000-8000-000000000000", "page_id": {1}, "title": "t"}}'
    lines = [good.format(1, 1), good.format(2, 1), good.format(1, 3), good.format(4, 4), "", "odd", '{"id": 1}', *['{"title": "x"}'] * 40, good.format(5, "null")]
    found = catalog.registry_defects(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string"))
    got = {r.line_no: r.problem for r in found.collect()}
    assert got == {1: "page_id again", 2: "id again", 5: "not an object", 6: "wrong keys", **dict.fromkeys(range(7, 47), "wrong keys"), 47: "bad page_id"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no task gathers the lines without a key


def test_log_files_hold_a_run_in_the_order_of_its_events(spark, tmp_path):
    from millrace.plans import core_queries

    rows = spark.range(2000).select(F.col("id").alias("event_id"), (F.col("id") * 7 % 50).alias("user_id"), F.lit("click").alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.orderBy(F.desc("event_id")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    lines: dict[str, list[tuple[int, float]]] = {}
    for r in core_queries()[0]["scan_log_files"](spark, str(tmp_path)).collect():
        lines.setdefault(r.run, []).append((r.seq, float(r.message.split("|")[1])))
    assert len(lines) == 5
    for found in lines.values():
        values = [v for _, v in sorted(found)]
        assert values == sorted(values)


def test_plain_tags_are_read_as_the_parser_reads_them():
    class Slow(infobox._Page):
        parse_starttag, parse_endtag = HTMLParser.parse_starttag, HTMLParser.parse_endtag

    draw = random.Random(4)
    parts = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<th class='tooltip'>", "</th>", "<ul>", "</ul>", "<li>", "</li>", "<b>", "</b>", "<a>", "<a href='/page/x'>", "</a>", "<p>", "</P>", "<TD>", "<td", "<b/>", "</b x>", "<script>", "</script>", "<div class='mw-parser-output'>", "</div>", "x &amp; y", "<", "</", ">", "&", " "]
    for _ in range(400):
        text = "<div class='mw-parser-output'><table><tr>" + "".join(draw.choices(parts, k=60))
        slow = Slow()
        slow.feed(text)
        slow.close()
        assert infobox.parse_page(1, text) == infobox._relations(1, slow), text


def test_one_small_file_is_parsed_on_all_cores(spark, tmp_path):
    spark.range(40).selectExpr("id as page_id", "'<a href=\"/page/x\">x</a>' as html").coalesce(1).write.parquet(f"{tmp_path}/pages")
    found = infobox.parse_pages(spark.read.parquet(f"{tmp_path}/pages")).withColumn("task", F.spark_partition_id())
    assert found.count() == 40 and found.select("task").distinct().count() > 3
