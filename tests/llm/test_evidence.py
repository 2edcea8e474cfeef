"""Brute force, held-out and edge tests of single methods."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, html_crf, ordinal, toxicity
from millrace.llm import queries as llm
from millrace.llm import recompress as R
from millrace.llm.decontaminate import best_stretch, drop_leaks, find_leaks
from millrace.llm.line_quality import clean_lines
from millrace.llm.mixing import mix_sources
from millrace.llm.simhash import keep_one, near_duplicates
from millrace.llm.vector import word_hashes

DATA = "/root/testdata/sf0.01"


def settled(docs: list[tuple[int, list[str]]], window: int, n_blocks: int, buckets: int) -> dict:
    """Which words of each document go, by the rounds of recompression with their exchanges done by dictionaries."""
    blocks = [sorted(docs[k::n_blocks]) for k in range(n_blocks)]
    names = lambda met, level: {k: (i + 1) * 8 + level for i, k in enumerate(k for k, n in met.items() if n > 1)}
    parts = [R.numbered(b"".join(" ".join(w).encode() + b"\n" for _, w in b), np.array([len(" ".join(w)) + 1 for _, w in b], np.int64)) for b in blocks]
    met: Counter = Counter()
    for _, keys, _, counts, _, _ in parts:
        met.update(dict(zip(keys, counts.tolist(), strict=True)))
    name = names(met, 0)
    tokens = []
    for b, (first, keys, _, _, words, runs) in zip(blocks, parts, strict=True):
        own = np.array([name.get(k, 0) for k in keys], np.int64)
        tokens.append(R.Tokens(np.array([i for i, _ in b], np.int64), first, own[words], own[runs]))
    returned: list[list] = [[] for _ in blocks]
    for level in range(1, R.ROUNDS + 2):
        met, sent = Counter(), []
        for t, r in zip(tokens, returned, strict=True):
            (a, b), _, twice, _ = R.distinct(t.layers(r)[2])
            sent.append(list(zip(a.tolist(), b.tolist(), strict=True)))
            for k, x in zip(sent[-1], twice.tolist(), strict=True):
                met[k] += 1 + x
        name = names(met, level)
        for r, keys in zip(returned, sent, strict=True):
            r.append(np.array([name.get(k, 0) for k in keys], np.int64))
    entries = [R.Entries(t, t.layers(r)[0], window, buckets) for t, r in zip(tokens, returned, strict=True)]
    groups: dict = {}
    for n, e in enumerate(entries):
        for m in e.messages():
            groups.setdefault(m["bucket"], []).append((n, m))
    flags: list[dict] = [{} for _ in entries]
    for bucket, group in groups.items():
        lists = [[R.from_planes(m[k]) for _, m in group] for k in ("words", "counts", "ids", "offsets")]
        later = R.later_windows(*map(np.concatenate, lists), window)
        for (n, _), x in zip(group, np.split(later, np.cumsum([x.sum() for x in lists[1]])[:-1]), strict=True):
            flags[n][bucket] = x
    out: dict = {}
    for b, e, f in zip(blocks, entries, flags, strict=True):
        gone = e.removed(np.concatenate([np.empty(0, bool), *[f[k] for k in sorted(f)]]).astype(bool))
        for i, (d, _) in enumerate(b):
            out.setdefault(d, []).append(gone[e.tokens.first[i] : e.tokens.first[i + 1]].tolist())
    return {k: sorted(v) for k, v in out.items()}


def brute_removed(docs: list[tuple[int, list[str]]], window: int) -> dict:
    first: dict = {}
    spots = [(i, s, tuple(w[s : s + window])) for i, w in docs for s in range(len(w) - window + 1)]
    for i, s, key in spots:
        first[key] = min(first.get(key, (1 << 62, 0)), (i, s))
    out: dict = {}
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone[s : s + window] = [True] * window
        out.setdefault(i, []).append(gone)
    return {k: sorted(v) for k, v in out.items()}


def test_recompression_equals_brute_force():
    for seed in range(300):
        draw = random.Random(seed)
        vocabulary, window = [f"w{i}" for i in range(draw.choice([1, 2, 2, 3, 5, 30, 400]))], draw.choice([1, 2, 3, 5, 8, 20, 20])
        docs: list = []
        for i in range(draw.randint(1, 14)):
            text = draw.choices(vocabulary, k=draw.randint(0, 80))
            for _ in range(draw.randint(0, 3) if docs else 0):
                other = draw.choice(docs)[1]
                a, at = draw.randint(0, len(other)), draw.randint(0, len(text))
                text = text[:at] + other[a : draw.randint(a, len(other))] + text[at:]
            if draw.random() < 0.2:
                text += [draw.choice(vocabulary)] * draw.randint(1, 60)
            docs.append((i if draw.random() < 0.9 else draw.randint(0, i), text))
        assert settled(docs, window, draw.randint(1, 4), draw.choice([1, 3, 16])) == brute_removed(docs, window), seed


def test_colliding_words_stay(spark, monkeypatch):
    """Words in the Thue-Morse pattern, equal under any polynomial modulo 2^64; and words that one hash confuses."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    frame = spark.createDataFrame([(1, " ".join([a] + [f"x{i}" for i in range(5)] * 6)), (2, " ".join([b] * 31))], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in R.dedup_substrings(frame).collect()}
    assert got == {r[0]: sum(sum(x) for x in r[1]) for r in brute_removed([(1, [a] + [f"x{i}" for i in range(5)] * 6), (2, [b] * 31)], 20).items()}
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    x, y = word_hashes(data, np.array([0, len(a) + 1]), np.array([len(a), len(a) + 1 + len(b)]))
    assert x != y
    monkeypatch.setattr(R, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(R, "window_hashes", lambda values, window: np.zeros(max(0, len(values) - window + 1), np.uint64))
    words = [f"v{i % 23}" for i in range(70)]
    docs = [(1, words), (2, words[::-1]), (3, words[10:50])]
    assert settled(docs, 20, 2, 3) == brute_removed(docs, 20)


def brute_leaks(texts: list[list[str]], items: list[list[str]]) -> set:
    found = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            for shift in range(-len(x) + 1, len(t)):
                a, b = max(0, shift), min(len(t), shift + len(x))
                same = np.array(t[a:b]) == np.array(x[a - shift : b - shift])
                if same.any() and best_stretch(same, 2)[0] >= min(len(x), max(8, 0.5 * min(len(x), 40))):
                    found.add((d, i))
                    break
    return found


def test_leaks_with_substitutions_against_brute_force(spark):
    """Every pair that the rule calls a leak, at any place and with any substitutions: none besides, and at least 0.95 of them."""
    draw = random.Random(21)
    prose = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    items = [prose(draw.randint(10, 60)) for _ in range(40)] + [prose(260), prose(6), prose(2)]
    texts = []
    for i, x in enumerate(items):
        for rate in (0.0, 0.1, 0.2, 0.3):
            texts.append(prose(60) + [w if draw.random() >= rate else f"s{draw.randrange(10**6)}" for w in x] + prose(60))
        texts.append(prose(50) + x[: max(8, len(x) // 2)] + prose(50))
        texts.append(prose(100))
        if i == 40:  # two copied ends with 100 foreign words between them
            texts.append(x[:80] + prose(100) + x[180:])
    frame = lambda rows, key: spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], f"{key} long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(frame(texts, "doc_id"), frame(items, "item_id")).collect()}
    want = {p for p in brute_leaks(texts, items) if len(items[p[1]]) >= 4}
    assert found <= want and len(found) >= 0.95 * len(want)
    assert {d for d, i in found if i == 41} >= {41 * 6 + 1}  # the item of six words, word for word
    everything = {(r.doc_id, r.item_id) for r in find_leaks(frame(texts, "doc_id"), frame(items, "item_id"), least_words=1).collect()}
    assert any(i == 42 for _, i in everything)


def test_long_texts_are_encoded_whole():
    enc = chat.encoding(chat.read_vocabulary())
    draw = random.Random(3)
    text = " ".join("".join(draw.choices("abcdefgäö", k=draw.randint(1, 12))) for _ in range(4000))
    assert len(text) > 4096 and enc.encode(text) == enc.pieces.encode_ordinary(text)
    gap = "a" + "\n" * 1500 + " b" + " " * 1200
    assert enc.encode(gap) == enc.pieces.encode_ordinary(gap)
    for long in (" " * 200_000 + "x", "ab" * 200_000, "\t" * 100_000):
        assert enc.decode_bytes(enc.encode(long)).decode() == long


def test_html_reads_as_browsers_do():
    text = lambda page: [x.text for x in html_crf.leaves(page)]
    assert text("&am<b>p;</b> x &lt<i>; y</i> &lt;") == ["&amp; x <; y <"]
    assert text("a <![CDATA[ b > c<p>d") == ["a c", "d"] and text("<!-->a<!--->b<!-- c -->d") == ["abd"]
    assert len(text("<div>x" * 20_000)) == 20_000
    long = html_crf.Leaf("word " * 500 + "Follow us and subscribe.", 0, html_crf.ROOT)
    assert {x for x in html_crf.features([long])[0] if x.startswith("says:")} == {"says:social:False", "says:sign:False"}


def test_mixing_with_excluded_nodes_equals_sql(spark, monkeypatch):
    mix = [(d, g, s, 0.0 if (d, g) == ("d1", "en") else w) for d, g, s, w in llm.MIX] + [("d3", "de", "src3", 0.0), ("d2", "fr", "src1", 5.0)]
    monkeypatch.setattr(llm, "MIX", mix)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    want = con.execute(llm.mix_sql(mix)).fetchall()
    names = [x[0] for x in con.description]
    assert sorted(map(tuple, llm.op4_mixing(spark, DATA).select(*names).collect())) == sorted(want)


def test_clashing_names(spark):
    """Columns of the input that bear names used inside stay as they are, and nothing fails."""
    text = " ".join(f"w{i}" for i in range(60)) + "."
    base = spark.createDataFrame([(1, text, "en", "s"), (2, text, "en", "s"), (3, " ".join(f"v{i}" for i in range(70)) + ".", None, None)], "doc_id long, text string, lang string, source string")
    odd = ("_out", "_gone", "_leak", "_n", "_bucket", "_end", "_lang", "_words", "_lines", "_good", "row", "x", "c", "e", "at", "salt", "id", "fp", "part", "leaf", "weight")
    docs = base.withColumns({c: F.lit(f"own {c}") for c in odd})
    kept = keep_one(docs).collect()
    assert {r.doc_id for r in kept} == {1, 3} and all(r[c] == f"own {c}" for r in kept for c in odd)
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l", "y")], "item_id long, text string, doc_id string")
    left = drop_leaks(docs, items).collect()
    assert len(left) == 3 and all(r[c] == f"own {c}" for r in left for c in odd)
    lines = clean_lines(docs).collect()
    assert all(r[c] == f"own {c}" for r in lines for c in odd) and lines[0].clean_text == text
    weights = spark.createDataFrame([("d", None, None, 1.0)], "domain string, lang string, source string, weight double")
    taken = mix_sources(docs, weights, domain=F.lit("d"), share=1.0).collect()
    assert len(taken) == 2 and all(r[c] == f"own {c}" for r in taken for c in odd)
    assert near_duplicates(docs).count() == R.dedup_substrings(docs).count() == 3


def test_long_texts(spark):
    """A text of two megabytes beside short ones."""
    draw = random.Random(1)
    long = " ".join(f"w{draw.randrange(50_000)}" for _ in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long[:400_000]), (3, "short text")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in R.dedup_substrings(docs).collect()}
    n = len(long[:400_000].split())
    assert got[1] == (300_000, 0) and got[2][0] == n and got[2][1] >= n - 1
    assert len({r.component_id for r in near_duplicates(docs).collect()}) >= 2
    item = spark.createDataFrame([(1, " ".join(long.split()[200_000:200_030]))], "item_id long, text string")
    assert {r.doc_id for r in find_leaks(docs, item).collect()} == {1}
    assert {r.doc_id: r.n_words for r in clean_lines(docs).collect()}[1] == 300_000


def held_out_auc(score: dict, label: dict) -> float:
    ones, zeros = ([score[i] for i, y in label.items() if y == k and i in score] for k in (1, 0))
    both = np.argsort(np.argsort(np.array(ones + zeros)))
    return float((both[: len(ones)].sum() - len(ones) * (len(ones) - 1) / 2) / (len(ones) * len(zeros)))


@pytest.mark.parametrize("table", ["/root/testdata/sf0.1"])
def test_classifiers_on_held_out_rows(spark, table):
    """Trained on the rows that the queries may learn from, judged on the others."""
    docs, labels = spark.read.parquet(f"{table}/documents.parquet"), spark.read.parquet(f"{table}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    test = docs.join(labels, "doc_id").where(out).select("doc_id", "text", "toxic", "quality").orderBy(F.xxhash64("doc_id")).limit(600).collect()
    model = toxicity.train(*toxicity.labelled_sample(docs, labels.where(~out)))
    score = dict(zip([r.doc_id for r in test], toxicity.score_texts(model, [r.text for r in test]).tolist(), strict=True))
    assert held_out_auc(score, {r.doc_id: r.toxic for r in test}) > 0.9
    rating = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    graded = ordinal.train(*ordinal.graded_sample(docs, labels.where(~out), rating))
    tail = ordinal.grade(graded, [r.text for r in test])
    assert held_out_auc(dict(zip([r.doc_id for r in test], tail[:, 0].tolist(), strict=True)), {r.doc_id: r.quality for r in test}) > 0.85


def test_packed_windows_remove_what_the_block_itself_would():
    draw = np.random.default_rng(8)
    docs = [b" ".join(draw.choice([b"a", b"bb", b"longer-words", b"c"], n).tolist()) for n in (0, 40, 0, 0, 3, 60, 30)]
    first, keys, _, counts, words, runs = R.numbered(b"".join(d + b"\n" for d in docs), np.array([len(d) + 1 for d in docs], np.int64))
    names = np.where(counts > 1, np.arange(1, len(keys) + 1) * 8, 0)
    tokens = R.Tokens(np.arange(len(docs)), first, names[words], names[runs])
    whole = R.Entries(tokens, tokens.layers([])[0], 4, 3)
    row = whole.packed() | {"ids": R.planes(tokens.ids), "first": R.planes(first)}
    again = R.Entries.of(row, 4, tokens)
    assert len(whole.start) and list(again.messages()) == list(whole.messages())
    flags = draw.integers(0, 2, int(whole.count[whole.heads].sum())).astype(bool)
    assert np.array_equal(R.Entries.of(row, 4).removed(flags), whole.removed(flags)) and whole.removed(flags).any()


def test_words_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(R, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    for x, y in ((b"ab", b"ac"), (b"12345678", b"12345679"), (b"12345678a", b"12345678b"), (b"a" * 16 + b"x" * 8, b"a" * 16 + b"x" * 7 + b"y")):
        _, keys, _, counts, words, _ = R.numbered(x + b" " + y + b" " + x, np.array([2 * len(x) + len(y) + 2]))
        assert (keys, counts.tolist(), words.tolist()) == ([x, y], [2, 1], [0, 1, 0])
    met, head = R.first_met(np.array([7, 3, 7, 9, 3], np.uint64))
    assert (met.tolist(), head.tolist()) == ([0, 1, 0, 2, 1], [0, 1, 3])
