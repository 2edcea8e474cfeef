"""Spelling variants, URL filters and hard negatives against brute force, with edge cases, and against their SQL."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries as llm
from millrace.llm.negatives import mine_negatives, scores, whole_vectors
from millrace.llm.spelling import group_variants, near_in_tiles, matrices, word_counts
from millrace.llm.url_filter import filter_urls

DATA = "/root/testdata/sf0.001"


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(numbers: dict[str, int], times: int = 10) -> list[tuple]:
    near = {w: [x for x in numbers if one_edit(w, x)] for w in numbers}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-numbers[x], x), default=None)
        if best is not None and numbers[best] >= times * numbers[w]:
            form[w] = best

    def root(w: str) -> str:
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), numbers[w], len(near[w]), numbers.get(form.get(w))) for w in numbers)


@pytest.mark.parametrize(("alphabet", "size", "share"), [("ab", 300, 16), ("abcdeé", 400, 7), ("abc一\U0001f600", 300, 4096)])
def test_variants_equal_brute_force(spark, alphabet, size, share):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices(alphabet, k=draw.choice((1, 2, 3, 7, 7, 8, 9, 10, 40)))) for _ in range(size)})
    numbers = {w: draw.choice((2, 3, 5, 20, 30, 300, 4000, 50_000)) for w in words}
    table = spark.createDataFrame(list(numbers.items()), "word string, n long")
    got = group_variants(table, share=share).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r) for r in got.collect()) == brute_variants(numbers)


def test_tiles_of_long_words():
    words = ["a" * 5000, "a" * 4999, "a" * 4998 + "b" + "a", "b" * 5000]
    i, j = near_in_tiles(matrices(words), matrices(words), 5000, True, True)
    assert {(int(a), int(b)) for a, b in zip(i, j, strict=True)} == {(0, 1), (0, 2), (1, 2)}


def test_word_counts(spark):
    texts = [(1, "Running running, RUNNING été-Étéétéé ununun1ununun"), (2, None), (3, ""), (None, "running " * 3), (4, "Étéétéé \n" * 2 + "x" * 30_000)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, word int")
    assert {r.word: r.n for r in word_counts(docs).collect()} == {"running": 6, "Étéétéé": 3}
    assert group_variants(word_counts(docs.where("false"))).count() == 0
    twice = spark.createDataFrame([("running", 1), ("running", 2), ("runing", 1), (None, 3)], "word string, n long")
    assert {(r.word, r.n, r.n_near) for r in group_variants(twice).collect()} == {("running", 3, 1), ("runing", 1, 1)}


def plain_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


@pytest.mark.parametrize("n_rules", [0, 1, 20, 200])
def test_urls_equal_brute_force(spark, n_rules):
    draw = random.Random(n_rules)
    hosts = ["a.net", "net", "b.a.net", "xnet", "org", "a.org", "b.c.a.org", "É.Net", "a.b:80", "", ".", "..net", "NET", "u@a.net"]
    paths = ["", "/", "/en/", "/en", "/en/8", "/en/85", "/fr//", "//", "/en/8/x", "/de/"]
    urls = [None, "", "no", "http://", "://", "a\nb://A.net/en/8\n?x", "http://" + "a." * 1500 + "net" + "/x" * 2000]
    urls += [f"http://{h}{p}{t}" for h in hosts for p in paths for t in ("", "?a=/b", "#://x.net/")]
    given = [(i % 5 or None, u, "clash") for i, u in enumerate(urls)]
    rules = [(draw.choice([*hosts, None]), draw.choice([*paths, None]), draw.choice(("block", "allow", None))) for _ in range(n_rules)]
    pages = spark.createDataFrame(given, "page_id long, url string, host string")
    got = filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    once: dict = {}
    for h, p, v in rules:
        key = plain_parts(f"x://{h or ''}")[0], p or ""
        once[key] = once.get(key, False) or v == "block"
    want = []
    for i, u, _ in given:
        host, path = plain_parts(u)
        fits = [(len(h) + len(p), len(h), block, h + p) for (h, p), block in once.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        want.append((i, host, path, best[3] if best else None, "block" if best and best[2] else "allow"))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert filter_urls(pages.where("false"), got.sparkSession.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def brute_negatives(rows: list[tuple], step: int) -> list[tuple]:
    sound = lambda i, v, l: None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)  # noqa: E731, E741
    known = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if sound(i, v, l)]  # noqa: E741
    out = []
    for at, (i, v, label) in enumerate(known):
        if i % step:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, k) for k, (j, w, _) in enumerate(known) if k != at)
        for p, positive, _ in [x for x in ranked if known[x[2]][2] == label][:5]:
            fit = [(s, j) for s, j, k in ranked if known[k][2] != label and -30 * p <= -100 * s <= -90 * p]
            out += [(i, positive, rank, j, -p, -s) for rank, (s, j) in enumerate(fit[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize(("kind", "n", "dims", "most"), [("plain", 300, 8, 16), ("plain", 150, 3, 4096), ("ties", 300, 2, 7), ("huge", 60, 4, 10)])
def test_negatives_equal_brute_force(spark, kind, n, dims, most):
    draw = random.Random(2)
    one = {"plain": lambda: draw.uniform(-1, 1), "ties": lambda: draw.choice((0.0, 0.5, 1.0, -0.5)), "huge": lambda: draw.uniform(-1, 1) * 1e6}[kind]
    rows = []
    for k in range(n):
        i, v, label = draw.randrange(0, n // 2) * 5, [one() for _ in range(dims)], draw.randrange(3)
        odd = {1: None, 2: [None, *v[1:]], 3: [float("nan"), *v[1:]], 4: [float("-inf"), *v[1:]], 7: v[:-1], 8: [], 9: [0.25] * dims}
        v = odd.get(k % 23, v)
        rows.append((None if k % 23 == 6 else i, v, None if k % 23 == 5 else label))
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, score int")
    got = mine_negatives(whole_vectors(table), F.col("id") % 20 == 0, most=most)
    want = brute_negatives(rows, 20)
    assert want and sorted(tuple(r) for r in got.collect()) == want
    assert mine_negatives(whole_vectors(table.where("false")), F.col("id") % 20 == 0).count() == 0


def test_scores_are_exact():
    for top in (10, 2**20, 2**29, 2**40):
        x, y = (np.array([[top, -top, 3], [1, top - 1, 0]]) + k for k in (0, 1))
        plain = [[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in y] for u in x]
        assert scores(x, y).tolist() == np.clip(np.array(plain, object), -(2**63), 2**63 - 1).tolist()


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_url_filter", "op13_hard_negatives"])
def test_query_equals_sql(spark, name):
    found = llm.QUERIES[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    cursor = con.execute(llm.ORACLES[name])
    columns = [x[0] for x in cursor.description]
    want = cursor.fetchall()
    assert want and sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, want))
