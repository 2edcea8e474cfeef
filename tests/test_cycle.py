"""Parsing in linear time, pages that fail alone, the cycle against a row-by-row model, and extraction as a stream."""

from __future__ import annotations

import json
import random
import shutil
import time
from pathlib import Path

from pyspark.sql import functions as F

from millrace.operators.cycle import NO_CONTENT, NO_TABLE, NOT_HELD, commit, run_cycle
from millrace.operators.infobox import _Page, _read, _relations, judged_page, parse_page
from millrace.operators.items import extract_items, picked_rows, read_pages, typed_fields
from millrace.sources.records import scan_records
from millrace.sources.snapshots import manifest, read_snapshot
from millrace.streaming.items import stream_items

HOST = "https://wiki.example.org/page/"
QUEUE = "id long, item_name string, update_page string, wiki_url string, status string, started_at timestamp, completed_at timestamp, error_message string, retry_count long"
#: A character reference of so many digits is no number that Python reads.
BROKEN = '<div class="mw-parser-output">&#' + "9" * 5000 + ";</div>"


def page(number: int | None, name: str, level: str = "3", body: str | None = None, categories: str = "Rings") -> str:
    table = f"<table><tr><th>Minimum Level</th><td>{level}</td></tr><tr><th>Odd</th><td>x</td></tr></table>"
    own = f'"wgArticleId":{number},' if number is not None else ""
    return f'<html><script>X={{{own}"wgCategories":["{categories}"]}};</script><h1>Item:{name}</h1>' + (f'<div class="mw-parser-output">{table}</div>' if body is None else body)


def test_open_elements_cost_linear_time():
    begun = time.perf_counter()
    rows = parse_page(1, '<div class="mw-parser-output"><table><tr><th>x</th><td>' + "<p>t " * 20_000)
    assert time.perf_counter() - begun < 3 and rows[0]["text"] == " ".join(["t"] * 20_000)


def test_a_page_that_cannot_be_read_has_one_row():
    (row,) = judged_page(1, BROKEN, "h")
    assert (row["kind"], row["label"], row["tooltip"]) == ("page", "error", "h") and row["text"].startswith("ValueError")
    assert judged_page(1, None, None)[0]["label"] == "no_content"
    assert [r["label"] for r in judged_page(1, page(1, "a"), None)] == ["read", "Minimum Level", "Odd"]


def test_pages_of_one_id_stay_apart_and_take_registry_ids(spark):
    rows = [(7, "u1", page(1, "A", "4")), (7, "u2", page(2, "B", "6")), (None, "u3", page(None, "C", "8"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    registry = spark.createDataFrame([("own", 2, "t")], "id string, page_id long, title string")
    got = {r.name: (r.page_key, r.minimum_level, r.wiki.url, r.id) for r in extract_items(pages, registry=registry).collect()}
    minted = got["A"][3]
    assert got == {"A": (7, 4, "u1", minted), "B": (7, 6, "u2", "own"), "C": (None, 8, "u3", None)} and len(minted) == 36


def test_cycle_equals_a_row_by_row_model(spark, tmp_path):
    draw = random.Random(5)
    kinds = {"good": None, "broken": "ValueError", "empty": NO_CONTENT, "bare": NO_TABLE, "skip": None, "missing": NOT_HELD, "anonymous": None}
    names = {f"P{k}": draw.choice(list(kinds)) for k in range(24)} | {"Q broken": "broken", "Q good": "good"}
    none = '<div class="mw-parser-output">none</div>'
    html = {
        "good": lambda k, n: page(k, n), "broken": lambda k, n: BROKEN, "empty": lambda k, n: draw.choice([None, "", "<p>x</p>"]), "bare": lambda k, n: page(k, n, body=none),
        "skip": lambda k, n: page(k, n, body=none, categories="Odd consumables"), "anonymous": lambda k, n: page(None, n),
    }
    pages = [(f"{HOST}Item:{n.replace(' ', '_')}", html[kind](100 + k, n), 1) for k, (n, kind) in enumerate(names.items()) if kind != "missing"]
    pages += [(f"{HOST}Item:{n}", page(5000, "stale"), 0) for n, kind in names.items() if kind in ("good", "bare")]
    queue, want = [], {}
    for i in range(60):
        name = draw.choice(list(names))
        status, tries = draw.choice([("pending", 0), ("pending", 2), ("failed", 1), ("failed", 3), ("complete", 0)])
        update = draw.choice(["Update_4_named_items", "Update_11_named_items", "Odd"])
        queue.append((i, name, update, f"{HOST}Item%3A{name.replace(' ', '%20')}", status, None, None, None, tries))
        if status == "complete" or (status == "failed" and tries >= 3):
            continue
        error = kinds[names[name]]
        want[i] = ("failed", error, tries + 1) if error else ("complete", None, tries)
    root = f"file://{tmp_path}/c"
    frame = spark.createDataFrame(queue, QUEUE)
    registry = spark.createDataFrame([], "id string, page_id long, title string")
    done = run_cycle(frame, spark.createDataFrame(pages, "url string, html string, fetched_at long"), registry, F.lit("2026-01-01").cast("timestamp"))
    commit(spark, root, done, buckets=3)
    got = {r.id: (r.status, r.error_message and r.error_message.split(":")[0], r.retry_count) for r in read_snapshot(spark, f"{root}/queue").collect()}
    assert got == want
    ran = [(n, {"Odd": "unknown"}.get(u, "-".join(u.split("_")[:2]).lower())) for i, n, u, *_ in queue if i in want]
    rank = lambda u: int(u.split("-")[1]) if "-" in u else 1 << 30
    stored = {n: min((u for m, u in ran if m == n), key=rank) for n, _ in ran if names[n] == "good"}
    records = [(r.path.split("/")[0], json.loads(r.record)) for r in scan_records(spark, f"{root}/items").collect()]
    assert {(u, x["name"], x["wiki"]["page_id"]) for u, x in records} == {(u, n, 100 + list(names).index(n)) for n, u in stored.items()}
    told = {(r.update, r.name, r.skipped is not None, "wiki.page_id" in r.errors) for r in read_snapshot(spark, f"{root}/reports").collect()}
    assert told == {(u, n, names[n] == "skip", names[n] == "anonymous") for n, u in ran if names[n] in ("good", "skip", "anonymous")}
    assert {r.page_id for r in read_snapshot(spark, f"{root}/registry").collect()} == {x["wiki"]["page_id"] for _, x in records}
    assert {n for n, k in names.items() if k == "broken"} and stored


def test_stream_survives_a_replay_and_takes_the_last_fetch(spark, tmp_path):
    root, source, checkpoint = (f"file://{tmp_path}/{x}" for x in ("t", "s", "c"))
    rows = [(f"{HOST}Item:P{k}", page(k, f"P{k}", str(k)), 5, "update-1") for k in range(8)]
    refetched = [(f"{HOST}Item:P1", page(1, "P1", "41"), 9, "update-1"), (f"{HOST}Item:P2", page(2, "P2", "42"), 3, "update-1"), (f"{HOST}Item:P3", "<p>gone</p>", 9, "update-1")]
    kind = "url string, html string, fetched_at long, update string"

    def run(new):
        if new:
            spark.createDataFrame(new, kind).coalesce(1).write.mode("append").parquet(source)
        stream_items(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source), root, checkpoint, buckets=4)
        return {json.loads(r.record)["name"]: json.loads(r.record)["minimum_level"] for r in scan_records(spark, root).collect()}

    run(rows[:5])
    last = run([*rows[5:], *refetched])
    assert last == {f"P{k}": k for k in range(8)} | {"P1": 41}
    version = manifest(spark, root).version
    commits = Path(checkpoint.removeprefix("file://")) / "commits"
    newest = max(int(x.name) for x in commits.iterdir() if x.name.isdigit())
    for x in (str(newest), f".{newest}.crc"):  # as if the query broke after the table was written
        (commits / x).unlink(missing_ok=True)
    assert run([]) == last and manifest(spark, root).version == version
    shutil.rmtree(checkpoint.removeprefix("file://"))  # a new stream reads all pages again
    assert run([]) == last and manifest(spark, root).version == version + 2


def test_an_end_tag_named_like_a_mark_ends_nothing():
    rows = judged_page(1, '<div class="mw-parser-output"><table><tr><th>A</th><td><span class="sortkey">1</sortkey>2</span> 3</td></tr></table></div>', "h")
    assert [(r["label"], r.get("text")) for r in rows] == [("read", None), ("A", "3")]


def test_pages_are_read_in_steps_as_by_the_parser_alone():
    class Slow(_Page):
        def _steps(self, i):
            return i

    draw = random.Random(6)
    parts = ["<table>", "</table>", "<tr>", "<td>", "</td>", "<th>", '<th class="tooltip">', "</th>", "<ul>", "</ul>", "<li>", '<li class="sortkey">', "</li>", "<b>", "</b>", '<a href="/page/x">', '<a href="/p&amp;y" title="a>b">', "</a>", "</b x>", "<p/>", "<script>", "</script>", "<!-- <td> -->", "<!doctype html>", "<title>", "x &amp; y", "&#6", "<", "</>", ">", "\n"]
    for _ in range(400):
        text = '<div class="mw-parser-output"><table><tr><td><ul><li>' + "".join(draw.choices(parts, k=60))
        slow, read = Slow(), _read(text)
        slow.feed(text)
        slow.close()
        assert _relations(1, read) == _relations(1, slow), text
        assert (read.has_content, read.has_body, len(read.stack)) == (slow.has_content, slow.has_body, len(slow.stack))
    many = _read('<div class="mw-parser-output"><ul>' + '<li><b class="n">x</b> y</li>' * 50)
    assert len(many.stack) == 2 and not any(many.in_list)


def test_nothing_behind_the_parse_shuffles_its_rows(spark):
    pages = spark.createDataFrame([(k, "u", page(k, "A")) for k in range(9)], "page_id long, url string, html string")
    cells, entries = picked_rows(read_pages(pages))
    for df in (typed_fields(cells), entries):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
    assert typed_fields(cells).where("f_minimum_level = 3").count() == 9
