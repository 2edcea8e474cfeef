"""Canonical texts against another writer of JSON, snapshot tables, and the catalog of item records with its checks."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.canonical import rendered
from millrace.operators.quality import item_file_checks, written_type
from millrace.sources.records import scan_records, write_records
from millrace.sources.snapshots import bucket_of, manifest, read_snapshot, upsert_snapshot, vacuum


def test_canonical_text_equals_another_writer(spark):
    draw = random.Random(1)
    kind = StructType.fromDDL("a string, b bigint, c double, d boolean, e array<string>, f struct<g:double,h:array<struct<i:string,n:string>>>, m map<string,string>, z array<bigint>")
    texts = [None, "", 'é"\\\n\r\t\b\f/\x7f \U0001f600', "\x00\x0b\x1f\x1a\\u000B", "\\u001F", "plain"]
    text = lambda: draw.choice([*texts, "".join(chr(draw.randrange(128)) for _ in range(9))])
    floats = [None, 0.0, -0.0, 1.0, 0.1, 1e-4, 1.5e-4, 1e-5, -2.5e-7, 1e7, 12345678.9, 1e15, 1.25e15, 123456789012345680.0, 1e16, -1e22, 1e100]
    number = lambda: draw.choice([*floats, draw.uniform(-1, 1) * 10 ** draw.randrange(-20, 20)])
    rows = []
    for _ in range(300):
        inner = draw.choice([None, {"g": number(), "h": draw.choice([None, [], [{"i": text(), "n": draw.choice([None, "5", "-7", "2.5", "6.0"])}]])}])
        rows.append({"a": text(), "b": draw.choice([None, 5, -3]), "c": number(), "d": draw.choice([None, True, False]), "e": draw.choice([None, [], [text(), text()]]), "f": inner, "m": draw.choice([None, {}, {'k"': "v", "\x0b": text()}]), "z": draw.choice([None, [], [1, None]])})
    table = spark.createDataFrame([tuple(r.values()) for r in rows], kind).select(F.struct(*kind.names).alias("r"))
    got = [r.x for r in table.select(F.expr(rendered("r", kind, numbers=frozenset({"f.h.n"}))).alias("x")).collect()]
    for r in rows:
        for h in (r["f"] or {}).get("h") or []:
            h["n"] = None if h["n"] is None else json.loads(h["n"])
    assert got == [json.dumps(r, indent=2, ensure_ascii=False) for r in rows]


def parts(root: str) -> set[Path]:
    return {x for x in Path(root.removeprefix("file://")).glob("data/*/*/*.parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    rows = spark.range(10_000).select(F.concat(F.lit("i"), "id").alias("id"), F.lit("old").alias("x"))
    assert manifest(spark, root) is None
    upsert_snapshot(spark, root, rows, "id", buckets=16)
    before = parts(root)
    assert len(before) == 16
    one = spark.createDataFrame([("i77", "new")], "id string, x string")
    upsert_snapshot(spark, root, one, "id")
    assert len(parts(root) - before) == 1 and before <= parts(root)
    assert read_snapshot(spark, root).count() == read_snapshot(spark, root, 1).count() == 10_000
    assert [r.id for r in read_snapshot(spark, root).where("x = 'new'").collect()] == ["i77"] and not read_snapshot(spark, root, 1).where("x = 'new'").count()
    with pytest.raises(Exception, match="broken"):  # noqa: B017  a failed write leaves the old snapshot
        upsert_snapshot(spark, root, one, "id", lambda held, changes: held.unionByName(changes.withColumn("x", F.raise_error(F.lit("broken")).cast("string"))))
    assert manifest(spark, root).version == 2 and read_snapshot(spark, root).count() == 10_000
    gone = lambda held, changes: held.join(changes.select("id"), "id", "left_anti")
    bucket = spark.range(1).select(bucket_of(F.lit("i77"), 16)).first()[0]
    all_of_it = rows.where(bucket_of(F.col("id"), 16) == bucket)
    assert str(bucket) not in upsert_snapshot(spark, root, all_of_it, "id", gone).folders
    left = read_snapshot(spark, root).count()
    assert left == 10_000 - all_of_it.count()
    assert vacuum(spark, root, keep=1) and read_snapshot(spark, root).count() == left and len(parts(root)) == 15
    assert upsert_snapshot(spark, root, one.where("false"), "id").version == 4 and read_snapshot(spark, root).count() == left


def test_a_batch_counts_once_and_two_writers_do_not_both_win(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    add = lambda held, changes: held.unionByName(changes)  # noqa: E731  not idempotent by itself
    row = spark.createDataFrame([("a", 1)], "id string, n int")
    for number in (0, 0, 1, 0):
        upsert_snapshot(spark, root, row, "id", add, batch=("s", number))
    assert read_snapshot(spark, root).count() == 2 and manifest(spark, root).batches == {"s": 1}

    def slow(held, changes):
        upsert_snapshot(spark, root, row, "id", add)  # another writer comes first
        return held.unionByName(changes)

    with pytest.raises(Exception, match="exist"):  # noqa: B017
        upsert_snapshot(spark, root, row, "id", slow)
    assert read_snapshot(spark, root).count() == 3


def records(spark, rows):
    """(id, update, category, slug, record) as the writer makes them, of (id, name, category, update)."""
    from millrace.operators.quality import record_text

    table = spark.createDataFrame([(i, n, c, u) for i, n, c, u in rows], "id string, name string, category string, update string")
    member = {
        "id": F.col("id"), "name": F.col("name"), "category": F.col("category"), "template": F.lit("t"), "wiki": F.struct(F.lit(7).cast("long").alias("page_id"), F.lit(None).cast("long").alias("revision_id"), F.lit("T").alias("title"), F.lit("u").alias("url")),
        "weight": F.lit(2.0), "effects": F.from_json(F.lit('[{"name":"Glow","value":"6"},{"name":"Dim","value":"0.5"}]'), written_type()["effects"].dataType), "extraction_errors": F.create_map(F.lit("hardness"), F.lit("soft")),
    }
    r = F.struct(*[member.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in written_type()])
    from millrace.functions.text import category_folder, file_slug

    return table.select("id", "update", category_folder(F.col("category")).alias("category"), file_slug(F.col("name")).alias("slug"), r.alias("r")).select("id", "update", "category", "slug", record_text("r").alias("record"))


def test_written_records_pass_all_checks(spark, tmp_path):
    root, uuid = f"file://{tmp_path}/c", "{:08d}-0000-4000-8000-000000000000".format
    first = records(spark, [(uuid(k), f"Ring {k}", "jewelry" if k % 2 else "odd", f"update-{k}") for k in range(1, 40)])
    write_records(spark, root, first, buckets=4)
    again = records(spark, [(uuid(3), "Belt", "clothing", "update-9"), (uuid(20), "Ring 20", "odd", "update-2"), (uuid(5), "Ring 5", "jewelry", "unknown"), (uuid(99), "New", "weapon", "unknown")])
    write_records(spark, root, again)
    files = scan_records(spark, root)
    paths = {r.path for r in files.collect()}
    assert len(paths) == 40 and {f"update-3/clothing/{uuid(3)}-belt.json", f"update-2/other/{uuid(20)}-ring-20.json", f"update-5/jewelry/{uuid(5)}-ring-5.json", f"unknown/weapon/{uuid(99)}-new.json"} <= paths
    registry = files.select(F.get_json_object("record", "$.id").alias("id"), F.lit(7).cast("long").alias("page_id"))
    problems = lambda rows: {n: df.count() for n, df in item_file_checks(rows, registry).items() if df.count()}
    assert problems(files) == {}
    shown = json.loads(files.where("path like '%belt%'").first().record)
    assert list(shown) == [f.name for f in written_type()] and shown["effects"][0]["value"] == 6 and shown["weight"] == 2.0
    for old, new in (("  ", "   "), ("6", "6.00"), ("2.0", "2"), ("}\n", "}"), ("\n", "")):
        changed = files.limit(1).withColumn("record", F.replace("record", F.lit(old), F.lit(new)) if old != "6" else F.replace("record", F.lit('"value": 6'), F.lit('"value": 6.00')))
        assert problems(changed) == {"chk_canonical": 1}, (old, new)
