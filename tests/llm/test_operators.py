"""Training-data operators on small tables: brute force, exact round trips, held-out accuracy, and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

from millrace.llm import chat, html_crf, minhash, ordinal, toxicity, warc
from millrace.llm import queries as llm
from millrace.llm.decontaminate import drop_leaks, find_leaks
from millrace.llm.graph import components
from millrace.llm.line_quality import clean_lines, passing
from millrace.llm.mixing import mix_sources
from millrace.llm.recompress import dedup_substrings
from millrace.llm.simhash import fingerprint_links, keep_one, majority_bits, near_duplicates, shingle_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts of few words with copies, near copies, shared passages, runs, empty and null texts, repeated and null ids."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ä", "é.", "A", "a"]
    shared = [" ".join(draw.choices(vocabulary, k=70)) for _ in range(3)]
    rows = []
    for i in range(n):
        text = " ".join(draw.choices(vocabulary, k=draw.randint(0, 120)))
        kind = i % 9
        if kind == 1:
            text += " " + draw.choice(shared) + "\n" + text[:100]
        elif kind == 2 and rows:
            text = draw.choice(rows)[1]
        elif kind == 3 and rows:
            text = (draw.choice(rows)[1] or "") + " extra"
        elif kind == 4:
            text = "go " * draw.randint(1, 80)
        elif kind == 5:
            text = draw.choice((None, "", " \t\n", "one", "ab ab " * 30))
        rows.append((i, text, draw.choice(("en", "de", None)), draw.choice(("src0", "src0", "src1", None)), 0))
    return [*rows, rows[1], (None, rows[1][1], "en", "src0", 0), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def windows_removed(rows: list[tuple], size: int = 20) -> dict:
    """First start (id, offset) of every window sequence, then the words of later ones; null ids last."""
    place = lambda i: 1 << 62 if i is None else i
    first: dict = {}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        for s in range(len(w) - size + 1):
            key = tuple(w[s : s + size])
            first[key] = min(first.get(key, (1 << 63, 0)), (place(i), s))
    out = []
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < (place(i), s):
                gone[s : s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = dedup_substrings(spark.createDataFrame(rows, DOCS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == windows_removed(rows)


def test_substrings_over_provided_documents(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert sorted((tuple(r) for r in llm.op10_substring_dedup(spark, DATA).collect()), key=str) == windows_removed(rows)


def brute_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    shingles = [" ".join(w[j : j + 4]) for j in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(docs):
    rows = [r for r in docs.collect()]
    prints = [brute_fingerprint(r.text) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    least = {}
    for r, c in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, 1 << 60), r.doc_id)
    want = sorted(((r.doc_id, f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root, strict=True)), key=str)
    got = near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = keep_one(docs).select("doc_id").collect()
    assert {r.doc_id for r in kept} == set(least.values())


def test_large_buckets_go_block_by_block(spark, monkeypatch):
    from millrace.llm import simhash

    monkeypatch.setattr(simhash, "BLOCK", 16)
    draw = random.Random(3)
    near = {7 ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(300)} | {draw.getrandbits(64) for _ in range(50)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in near)
    found = components(fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    root = {x: x for x in signed}
    for i, x in enumerate(signed):
        for y in signed[:i]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 4 and root[x] != root[y]:
                a, b = root[x], root[y]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    linked = {r.node: r.root for r in found}
    assert {x: linked.get(x, x) for x in signed} == root


def brute_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    spots: dict = {}
    for i in range(len(w) - 2):
        spots.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)}
    full = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered)


def test_quality_counts_equal_brute_force(docs):
    for r in clean_lines(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_lines(spark):
    prose = "\n".join(" ".join(f"word{i}{j}" for j in range(11)) + ", so it ends." for i in range(8))  # no repeats but the end
    junk = "\n".join(" ".join(f"w{i}{j}%%%" for j in range(12)) for i in range(8))
    menu = "\n".join(" | ".join(f"item{i}{j}" for j in range(9)) for i in range(8))
    rows = [(1, prose), (2, junk), (3, menu), (4, prose + "\nWe use cookies. Click here to accept."), (5, prose + "\n" + menu + "\n" + junk)]
    got = {r.doc_id: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in range(1, 6)] == [True, False, False, True, False]
    assert got[4].clean_text == prose
    clash = spark.createDataFrame([(1, prose, 5, "x")], "doc_id long, text string, N_WORDS int, kept string")
    assert passing(clash).select("doc_id", "n_words").collect()[0].n_words > 100


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    got = llm.op4_mixing(spark, DATA)
    want = con.execute(llm.ORACLES["op4_mixing"]).fetchall()
    names = [x[0] for x in con.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)


def test_mixing_edges(spark, docs, empty):
    from pyspark.sql import functions as F

    weights = spark.createDataFrame([("d", None, None, 1.0), ("d", "de", None, 0.0)], "domain string, lang string, source string, weight double")
    extra = docs.withColumn("whole", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    rows = mix_sources(extra, weights, domain=F.lit("d"), share=0.5).collect()
    assert rows and all(r.lang != "de" and r.n_tokens > 0 and r.n_epochs >= 1 for r in rows)
    total = sum(len(WORD.findall(r.text or "")) for r in docs.collect())
    assert sum(r.n_tokens * r.n_epochs for r in rows) <= 0.5 * total
    assert mix_sources(empty, weights, domain=F.lit("d")).count() == 0


def test_leaks(spark, docs, empty):
    draw = random.Random(4)
    item = [f"b{i}" for i in range(40)]
    changed = [x if k % 7 else f"z{k}" for k, x in enumerate(item)]
    half = item[:25]
    prose = lambda: [f"w{draw.randrange(500)}" for _ in range(200)]
    texts = [prose() + item + prose(), prose() + changed + prose(), prose() + half, prose(), prose() + item[:6] + prose(), None, []]
    table = spark.createDataFrame([(i, None if t is None else " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item).upper()), (1, " ".join(item)), (2, "too short to tell"), (3, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in find_leaks(table, items).collect()}
    assert set(found) == {(0, 1), (1, 1), (2, 1)}
    assert (found[0, 1].n_matched, found[0, 1].word_from) == (40, 200)
    assert found[1, 1].n_matched == sum(a == b for a, b in zip(item, changed, strict=True)) - (changed[0] != item[0]) * 0
    assert {r.doc_id for r in drop_leaks(table, items).collect()} == {3, 4, 5, 6}
    assert find_leaks(empty, items).count() == 0 and find_leaks(table, items.where("false")).count() == 0


def test_leaks_over_provided_documents(spark):
    table = [(r.doc_id, f" {' '.join(WORD.findall(r.text))} ") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, f" {' '.join(WORD.findall(r.text))} ") for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    whole = {(d, i) for d, text in table for i, x in items if x in text and len(x.split()) >= 8}
    found = {(r.doc_id, r.item_id) for r in llm.op9_decontamination(spark, DATA).collect()}
    assert whole <= found and len(found) <= len(whole) + 2


def gradient_error() -> float:
    net = toxicity.new_net(1)
    draw = np.random.default_rng(0)
    into = draw.standard_normal((9, toxicity.INPUTS)).astype(np.float32)
    index, size = draw.integers(0, 9, (4, 6)), np.array([6, 3, 1, 5])
    label = np.array([0, 1, 1, 0])

    def loss():
        z = toxicity.forward(net, into, index, size)
        return float(np.mean(np.log1p(np.exp(-np.where(label > 0, z, -z)))))

    keep: list = []
    slope = (toxicity._sigmoid(toxicity.forward(net, into, index, size, keep)) - label) / 4
    grad, d_into = toxicity.backward(net, into, index, keep, slope.astype(np.float32))
    worst = 0.0
    for array, g, at in ((net["h"], grad["h"], (0, 1, 2)), (net["x"], grad["x"], (1, 3, 20)), (net["a"], grad["a"], (2, 1)), (into, d_into, (3, 2))):
        old, step = array[at], 1e-2
        array[at] = old + step
        up = loss()
        array[at] = old - step
        down = loss()
        array[at] = old
        worst = max(worst, abs((up - down) / (2 * step) - g[at]))
    return worst


def test_toxicity_gradients():
    assert gradient_error() < 2e-3


def test_toxicity_held_out():
    draw = random.Random(5)
    clean = lambda n: [f"{draw.choice('abcdefgh')}{draw.choice(('er', 'in', 'on'))}{draw.choice(('ta', 'lo', 'mi'))}" for _ in range(n)]

    def text(bad):
        words = clean(draw.randint(10, 90))
        for _ in range(3 * bad):
            words[draw.randrange(len(words))] = "vexu" + draw.choice(("ba", "ce", "di", "fo", "gu"))
        return " ".join(words)

    labels = [i % 3 == 0 for i in range(300)]
    model = toxicity.train([text(y) for y in labels], np.array(labels), steps=120, rounds=2)
    test = [i % 2 == 0 for i in range(100)]
    score = toxicity.score_texts(model, [text(y) for y in test])
    assert ((score >= 0.7) == np.array(test)).mean() > 0.95
    assert toxicity.score_texts(model, ["", None, " \n"]).tolist() == [0.0] * 3
    late = " ".join(clean(5000) + ["vexuba"] * 3)
    assert toxicity.score_texts(model, [late])[0] >= 0.7
    assert toxicity.score_texts(toxicity.train(["a"], np.array([0])), ["x"]).tolist() == [0.0]


def test_ordinal_held_out():
    draw = random.Random(6)
    kinds = {0: "junk%%", 1: "fair", 2: "fine"}
    text = lambda g: " ".join(draw.choice([kinds[g], f"w{draw.randrange(50)}", f"v{draw.randrange(50)}"]) for _ in range(60))
    grades = np.array([i % 3 for i in range(240)])
    model = ordinal.train([text(g) for g in grades], grades, steps=120)
    assert np.all(np.diff(model["cuts"]) > 0)
    tail = ordinal.grade(model, [text(g) for g in grades])
    assert np.abs(tail.sum(axis=1) - grades).mean() < 0.3
    assert ordinal.grade(model, ["", None]).shape == (2, 2)
    assert ordinal.grade(ordinal.train(["a", "b"], [1, 1]), ["x"]).tolist() == [[1.0]]


def test_html_extraction():
    draw = random.Random(7)
    prose = [f"The {i} words of a plain paragraph stand here, and they say rather little. So be it." for i in range(40)]
    short = [f"Item {i}" for i in range(20)]
    sample = [html_crf.composed_page(draw, prose, short)[0] for _ in range(20)]
    pages = html_crf.training_pages(sample, 300)
    chain = html_crf.Chain.train(pages[:200])
    wrong = sum(a != b for names, labels in pages[200:] for a, b in zip(chain.decode(names), labels, strict=True))
    assert wrong < 0.03 * sum(len(labels) for _, labels in pages[200:])
    page = "<html><head><title>t</title><script>var x='</p>';</script></head><body><nav><a href=/a>A</a></nav><article><h1>A &amp; B</h1><p>One  two&nbsp;three <b>four</b>five, and so on it goes.<br><p>Next &#233; paragraph of words, here it ends.</article><footer>&copy; c</footer>"
    assert html_crf.main_text(chain, page) == "A & B\nOne two three fourfive, and so on it goes.\nNext é paragraph of words, here it ends."
    assert html_crf.main_text(chain, None) == "" == html_crf.main_text(chain, "")
    for odd in ("<", "<p", "<p class='", "<!--", "<script>x", "</p></p>", "<a" * 500, "&#xffffffff;"):
        html_crf.main_text(chain, odd)


def test_html_head_ends_by_itself():
    text = lambda page: [x.text for x in html_crf.leaves(page)]
    for end in ("", "</head>", "<body>", "</head><body>"):
        assert text(f"<html><head><title>T</title>\n<meta a=b><style>p {{}}</style>{end}<h1>A</h1><p>B <b>c</b>") == ["A", "B c"]
    assert text("<head><title>T</title><script>x</script> plain <p>B") == ["plain", "B"]
    long = [html_crf.Leaf("word " * 100 + "All rights reserved.", 0, html_crf.ROOT)]
    assert "says:rights:False" in html_crf.features(long)[0]


def test_samples_fill_up_with_short_texts(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"t{i} " * (50 if i % 4 else 1)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 20) for i in range(40)], "doc_id long, toxic int")
    for found, y in (toxicity.labelled_sample(docs, labels, max_rows=5, max_chars=20), ordinal.graded_sample(docs, labels, F.col("toxic"), max_rows=5, max_chars=20)):
        assert sorted(y.tolist()) == [0] * 5 + [1] * 5 and max(map(len, found)) <= 20


def test_samples_leave_out_ids_under_two_labels_and_are_ordered(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"t{i}") for i in range(30)] + [(1, f"again {k}") for k in range(40)] + [(None, "none")]
    labels = spark.createDataFrame([(i, i // 15) for i in range(30)] + [(2, 1), (3, 0), (20, 0), (4, None), (5, 7), (None, 1)], "doc_id long, toxic int")
    found = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(5)
        both = toxicity.labelled_sample(docs, labels, max_rows=15), ordinal.graded_sample(docs, labels, F.col("toxic"), max_rows=15)
        found.append([sorted(zip(texts, y.tolist(), strict=True)) for texts, y in both])
    assert found[0] == found[1]
    for sample, most in zip(found[0], (60, 90), strict=True):
        ids = {t[1:]: y for t, y in sample if t[0] == "t"}
        assert not {"2", "20"} & set(ids) and len(sample) <= most and "none" not in {t for t, _ in sample}
        assert all(y == int(i) // 15 for i, y in ids.items())


def test_mixing_passes_on_what_excluded_children_leave(spark):
    rows = [(i, "w " * 100, "xx" if i < 50 else "en", "a" if i < 60 else "b", 0) for i in range(100)]
    weights = spark.createDataFrame([("da", "xx", None, 0.0)], "domain string, lang string, source string, weight double")
    from pyspark.sql import functions as F

    got = mix_sources(spark.createDataFrame(rows, DOCS), weights, domain=F.concat(F.lit("d"), F.col("source")), share=0.5, max_epochs=1).collect()
    assert sum(r.n_tokens * r.n_epochs for r in got) == 5000 and all(r.lang == "en" for r in got)


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(8)
    names = [[f"f{i}"] for i in range(7)]
    for _ in range(30):
        chain = html_crf.Chain({f"f{i}": float(draw.normal()) for i in range(7)}, draw.normal(size=(2, 2)))
        value = lambda p, c=chain: sum(c.weights[f"f{i}"] * y for i, y in enumerate(p)) + sum(c.moves[a, b] for a, b in zip(p, p[1:], strict=False))
        paths = [[n >> i & 1 for i in range(7)] for n in range(128)]
        assert value(chain.decode(names)) == pytest.approx(max(map(value, paths)))


def test_chat_round_trip(spark):
    rows = [(1, 1, "assistant", "b <|im_end|> \\ <\\|x"), (1, 0, "user", None), (1, 1, "assistant", "b <|im_end|> \\ <\\|x"), (None, None, None, "é" * 9000), (2, 0, "assistant", ""), (2, 5, "<|im_start|>", "z\n\nz")]
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    learned = "b <|im_end|> \\ <\\|x" * 2
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[1].turns_sha256 == hashlib.sha256(("user\n\n" + "assistant\nb <|im_end|> \\ <\\|x\n" * 2).encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(("\n" + "é" * 9000 + "\n").encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"assistant\n\n<|im_start|>\nz\n\nz\n").hexdigest() and got[2].loss_chars == 0
    for text in ("<|", "<\\|", "<\\\\|", "<<||", "a|b<"):
        assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


def test_warc_round_trip(spark):
    big = "é" * 700
    rows = [(1, "http://a/ä b", big), (2, None, big), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u", None), (5, "u", None), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.round_trip(spark, pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([(1, 1400, "revisit", 2), (2, 1400, "response", None), (3, 999, "response", None), (4, 999, "response", None), (5, 0, "response", None), (5, 0, "response", None), (None, 1400, "revisit", 2)], key=str)
    assert warc.round_trip(spark, pages.where("false")).count() == 0


def test_warc_damage_is_seen():
    digest = hashlib.sha1(b"p" * 5000).hexdigest()
    plain = warc.record_bytes(1, "u", b"p" * 5000, digest, "response", None, "d")
    data = warc.gzip_member(plain)
    for step in (1, 100, 1 << 16):
        assert [warc.read_record(p)["payload_digest"] for p in warc.members(data[i : i + step] for i in range(0, len(data), step))] == [digest]
    for bad in (warc.gzip_member(plain.replace(b"ppp", b"pqp", 1)), data[:-9], warc.gzip_member(plain[:-2])):
        with pytest.raises((ValueError, zlib.error)):
            [warc.read_record(p) for p in warc.members(iter([bad]))]


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert near_duplicates(empty).count() == dedup_substrings(empty).count() == clean_lines(empty).count() == 0
    assert html_crf.extract_main_text(pages).count() == 0
    assert toxicity.score_toxicity(empty, {"prior": 0.0}).count() == 0
    assert chat.digests(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(9)
    line = lambda: " ".join(f"{draw.choice('abcdefghij')}{draw.randrange(300)}" for _ in range(14)) + "."
    text = lambda: "\n".join(line() for _ in range(10))
    item, passage = " ".join(f"q{i}" for i in range(30)), "\n".join(line() for _ in range(5))
    base = text()
    rows = [(0, base), (1, base), (2, text()), (3, text() + "\n" + passage), (4, passage + "\n" + text()), (5, text() + "\n" + item + "."), (6, "%% " * 90), (7, "short")]
    rows += [(i, text()) for i in range(8, 30)]
    spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)))
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
        if name != "target_mix":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    clean = set(range(30))
    assert set(seen["quality_rules"]) == clean - {6}  # a text of one word stays: length alone says nothing
    assert set(seen["near_duplicates"]) == clean - {1, 6}
    assert set(seen["repeated_substrings"]) == clean - {1, 6}
    assert passage.split()[3] + " " + passage.split()[4] in " ".join(seen["repeated_substrings"][3].split())
    assert len(seen["repeated_substrings"][4].split()) == len(rows[4][1].split()) - len(passage.split())
    assert set(seen["benchmark_leaks"]) == clean - {1, 5, 6}
    assert set(seen["target_mix"]) <= set(seen["benchmark_leaks"]) and seen["target_mix"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen["target_mix"])


def test_pipeline_removes_what_earlier_stages_left(spark, tmp_path):
    import corpus_pipeline
    from millrace.llm.common import WRITTEN

    draw = random.Random(19)
    text = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(90)) + "."
    rows = [(i, text(), "en", "src0", 0) for i in range(12)]
    spark.createDataFrame([(1, text())], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, DOCS)
    folders = lambda paths: [x for x in paths if Path(x.removeprefix("file://")).exists()]
    before = list(WRITTEN)
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        mark, old = len(WRITTEN), folders(WRITTEN)
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{at}")
        assert not set(folders(WRITTEN[:mark])) - set(folders(before)), "left by an earlier stage"
        assert set(folders(before)) <= set(old)
        docs = spark.read.parquet(f"{tmp_path}/{at}")
    assert docs.count()


def brute_similar(texts: list[str | None], similarity: float = 0.8) -> list[int]:
    """The number of the first text of each text's component."""
    low = [WORD.findall((t or "").lower()) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in low]
    root = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def test_pipeline_joins_edited_copies(spark):
    import corpus_pipeline

    draw = random.Random(11)
    text = lambda: [f"w{draw.randrange(900)}" for _ in range(200)]
    rows = []
    for _ in range(30):
        base = text()
        rows.append(base)
        for edits in (1, 2, 3, 4, 5, 8):  # similarity from about 0.95 to 0.67
            copy = list(base)
            for at in draw.sample(range(200), edits):
                copy[at] = "edited"
            rows.append(copy)
    chain = text()  # every link alone is similar, the ends are not
    for k in range(12):
        chain = chain[:k * 12] + [f"c{k}"] * 2 + chain[k * 12 + 2 :]
        rows.append(chain)
    texts = [" ".join(x) for x in rows]
    root = brute_similar(texts)
    table = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table, DATA).collect()}
    assert kept == set(root) and len(kept) < len(texts) / 2


def test_pipeline_joins_a_large_group_of_edited_copies(spark):
    import corpus_pipeline

    draw = random.Random(13)
    base = [f"w{draw.randrange(900)}" for _ in range(120)]
    texts = []
    for k in range(160):  # many are similar to a lightly edited copy only, or to none
        copy = list(base)
        for at in draw.sample(range(120), draw.randrange(1, 9)):
            copy[at] = f"e{k}" if k % 2 else f"e{at % 3}"
        texts.append(" ".join(copy))
    root = brute_similar(texts)
    table = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table, DATA).collect()}
    assert kept == set(root) and 10 < len(kept) < len(texts)
    in_blocks = minhash.keep_similar(table, size=5, similarity=0.8, block=7)
    assert {r.doc_id for r in in_blocks.collect()} == set(root)


def test_pipeline_links_by_simhash_what_shares_no_minhash_key(spark):
    draw = random.Random(21)
    base = [f"w{draw.randrange(900)}" for _ in range(300)]
    edited = [[*base[:k], "new", *base[k + 1 :]] for k in (40, 90, 299)]
    others = [[f"o{draw.randrange(900)}" for _ in range(n)] for n in (300, 4, 5)]
    texts = [" ".join(x) for x in (base, *edited, *others, base[:200])]
    hashes = [shingle_hashes(x, 5) for x in texts]
    marks = np.array([majority_bits(x) for x in hashes], np.uint64)
    distance = np.bitwise_count(marks[:, None] ^ marks[None])
    assert {r.node for r in components(spark.createDataFrame([(int(a), int(b)) for a, b in zip(*np.nonzero(distance <= 4), strict=True)], "a long, b long")).collect()} >= set(range(4))
    rows = [(k, len(set(h)), [k], f) for k, (h, f) in enumerate(zip(hashes, marks.view(np.int64).tolist(), strict=True))]
    heads = spark.createDataFrame(rows, "node long, n long, keys array<long>, fp long")
    sets = spark.createDataFrame([(k, np.unique(np.array(h, np.uint64)).view(np.int64).tolist()) for k, h in enumerate(hashes)], "node long, shingles array<long>")
    links = minhash.similar_links(heads, lambda nodes: sets.join(nodes, "node", "left_semi"), 0.8)
    assert {r.node: r.root for r in components(links).collect()} == dict.fromkeys(range(4), 0)


def test_overlaps_of_sets():
    draw = np.random.default_rng(4)
    x, y = ([np.unique(draw.integers(0, 400, k)) for k in sizes] for sizes in ((0, 5, 300, 90), (200, 0, 1)))
    assert minhash.overlaps(x, y).tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


def test_pipeline_tells_rows_of_one_id_apart(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(12)
    text = lambda: "\n".join(" ".join(f"w{draw.randrange(5000)}" for _ in range(20)) for _ in range(4))
    one, item, passage = text(), " ".join(f"q{i}" for i in range(30)), " ".join(f"p{i}" for i in range(25))
    ids = (None, 5)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = lambda rows: spark.createDataFrame([(i, t, "en", f"s{k}", len(t)) for k, (i, t) in enumerate(rows)], DOCS)
    left = lambda stage, rows: sorted(((r.doc_id, r.text, r.source, r.n_chars) for r in stage(spark, frame(rows), str(tmp_path)).collect()), key=str)
    want = lambda rows, change=lambda k, t: t: sorted(((i, x, f"s{k}", len(x)) for k, (i, t) in enumerate(rows) if (x := change(k, t))), key=str)
    own = [(i, text()) for i in ids for _ in range(4)]

    rows = [(1, one), *[(i, one) for i in ids], *own]  # copies of one text beside other texts of their ids
    gone = lambda k, t: None if k in (1, 2) else t
    assert left(corpus_pipeline.near_duplicates, rows) == want(rows, gone)
    assert sorted(map(str, keep_one(frame(rows)).collect())) == sorted(str(r) for k, r in enumerate(frame(rows).collect()) if k not in (1, 2))
    rows = [*own, *[(i, text() + " " + item) for i in ids]]
    assert left(corpus_pipeline.benchmark_leaks, rows) == want(rows, lambda k, t: None if k >= len(own) else t)
    rows = [(1, text() + "\n" + passage), *own, *[(i, text() + "\n" + passage) for i in ids], (None, passage + " x0"), (None, passage)]
    later = lambda k, t: t if k <= len(own) else " ".join(t.replace(passage, "").split())
    assert left(corpus_pipeline.repeated_substrings, rows) == want(rows, later)
    rows = [(None, passage + " y0"), (None, passage + " y1")]  # at the same word of two null ids
    assert sorted(len(x[1].split()) for x in left(corpus_pipeline.repeated_substrings, rows)) == [1, 26]


def test_held_out_is_defined_for_null_ids(spark):
    from millrace.llm.queries import _held_out

    rows = spark.createDataFrame([(i,) for i in (None, *range(60))], "doc_id long").select("doc_id", _held_out().alias("h")).collect()
    assert [r.h for r in rows] == [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows]
