"""Spelling variants: dense prefix-suffix tiling over the vocabulary, then each word's form and root.

Two words are near when one inserted, deleted or replaced code point turns one into the other, that is when their lengths differ by at
most one and common prefix plus common suffix reach the longer length m less one. Then the prefix or the suffix alone reaches m // 2,
so every word goes to four groups: for m its own length and one more, the words with its first m // 2 code points and those with its
last. Sorted groups are cut into tiles, padded matrices of code points, and pairs of tiles are compared column by column, which gives
the common prefix and suffix of all their pairs at once. A pair is reported by its prefix group, or by its suffix group if the prefix
is too short, so none comes twice. A group that outgrows a task's share travels on as blocks, whose pairs are dealt to other tasks.

Defined results. Null and empty texts have no words, an empty table gives no row. A null id counts as an empty one. A word of any length
is compared whole; tiles hold fewer words where words are long. Repeated words of a vocabulary count as one, their numbers added up;
other columns of the input are ignored. Ties between near words of one number go to the smallest in code-point order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Letters of a word, as a regex class body.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of a tile and of a task's share of a group, for short words; AREA bounds the code points of either.
TILE, SHARE, AREA = 256, 4096, 1 << 22

_PAIR = ["word", "other", "other_n"]
_FOUND = "word string, other string, other_n long, key string, block int, words array<string>, ns array<long>"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 7, twice: int = 2, change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): runs of letters of at least `least` code points, A-Z lower-cased, that occur `twice` times or more in all texts.

    change(id, word) may alter an occurrence; what it leaves shorter than `least` does not count. Occurrences are summed before they
    are shuffled.
    """
    runs = F.regexp_extract_all(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    found = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("word"))
    found = found.withColumn("word", F.when(F.col("word").rlike("[A-Z]"), F.translate("word", UPPER, UPPER.lower())).otherwise(F.col("word")))
    if change is not None:
        found = found.select(change(F.col("id"), F.col("word")).alias("word")).where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= twice)


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and code points padded with zeros, aligned left and right."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points) or points.max() < 256:
        points = points.astype(np.uint8)
    lengths = np.array([len(x) for x in words], np.int64)
    width = int(lengths.max(initial=0))
    at = np.arange(width)
    left, right = (np.zeros((len(words), width), points.dtype) for _ in range(2))
    left[at[None] < lengths[:, None]] = points
    right[at[None] >= width - lengths[:, None]] = points
    return lengths, left, right


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Columns, from the first, in which each row of x equals each row of y."""
    n = np.zeros((len(x), len(y)), np.uint8 if x.shape[1] < 256 else np.int32)
    alive = np.ones(n.shape, bool)
    for a, b in zip(x.T, y.T, strict=False):
        alive &= a[:, None] == b[None]
        if not alive.any():
            break
        n += alive
    return n


def near_in_tiles(x: tuple, y: tuple, m: int, by_prefix: bool, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of the near pairs of two tiles whose longer word has m code points; of one tile with itself, i < j."""
    (lx, left_x, right_x), (ly, left_y, right_y) = x, y
    prefix = _common(left_x, left_y)
    width = min(right_x.shape[1], right_y.shape[1])
    suffix = _common(right_x[:, right_x.shape[1] - width :][:, ::-1], right_y[:, right_y.shape[1] - width :][:, ::-1])
    shorter = np.minimum(lx[:, None], ly[None])
    prefix, suffix = np.minimum(prefix, shorter), np.minimum(suffix, shorter)
    near = (prefix + suffix >= m - 1) & (np.maximum(lx[:, None], ly[None]) == m) & (shorter >= m - 1)
    near &= prefix >= m // 2 if by_prefix else (suffix >= m // 2) & (prefix < m // 2)
    return np.nonzero(np.triu(near, 1) if same else near)


def _tiles(words: list[str], m: int) -> list[tuple[int, tuple]]:
    step = max(1, min(TILE, AREA // (16 * max(1, m))))
    return [(at, matrices(words[at : at + step])) for at in range(0, len(words), step)]


def _near(words: list[str], ns: list[int], others: list[str], other_ns: list[int], key: str, same: bool) -> pa.RecordBatch:
    """Both directions of every near pair of two lists of words of one length class, or of one list with itself."""
    m, by_prefix = int(key[1 : key.index(":")]), key[0] == "p"
    found: tuple[list, list, list] = ([], [], [])
    mine = _tiles(words, m)
    for a, x in mine:
        for b, y in mine if same else _tiles(others, m):
            if same and b < a:
                continue
            for i, j in zip(*(k.tolist() for k in near_in_tiles(x, y, m, by_prefix, same and a == b)), strict=True):
                i, j = a + i, b + j
                found[0].extend((words[i], others[j]))
                found[1].extend((others[j], words[i]))
                found[2].extend((other_ns[j], ns[i]))
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found, kinds, strict=True)], _PAIR)


def _rows(pairs: pa.RecordBatch | None = None, blocks: list[tuple] = ()) -> pa.RecordBatch:
    """A batch of _FOUND: near pairs, or blocks (key, block, words, ns)."""
    n, pairs = len(blocks), pairs if pairs is not None else pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.string(), pa.int64())], _PAIR)
    kinds = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
    own = [pa.concat_arrays([c, pa.nulls(n, c.type)]) for c in pairs.columns]
    rest = [pa.concat_arrays([pa.nulls(pairs.num_rows, t), pa.array([b[k] for b in blocks], t)]) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*own, *rest], [*_PAIR, "key", "block", "words", "ns"])


def _group_pairs(most: int):
    """Reads (key, word, n) sorted by key. Whole groups are compared here, small ones of one length class together; a group of more than
    `most` words, fewer if they are long, goes out as blocks."""
    kind = lambda key: key[: key.index(":")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[str] = []
        words: list[str] = []
        ns: list[int] = []
        blocks = 0  # blocks that the first group has given so far

        def take(n: int, as_block: bool) -> pa.RecordBatch:
            nonlocal keys, words, ns
            w, c, key = words[:n], ns[:n], keys[0]
            out = _rows(blocks=[(key, blocks, w, c)]) if as_block else _rows(_near(w, c, w, c, key, True))
            keys, words, ns = keys[n:], words[n:], ns[n:]
            return out

        def settle(ended: bool) -> Iterator[pa.RecordBatch]:
            nonlocal blocks
            while keys:
                share = max(1, min(most, AREA // max(1, int(kind(keys[0])[1:]))))
                if len(keys) <= share and not ended:
                    return
                if blocks or (len(keys) > share and keys[share] == keys[0]):  # a group of blocks; the next starts where its key ends
                    end = next((i for i in range(min(len(keys), share)) if keys[i] != keys[0]), min(len(keys), share))
                    more = end < len(keys) and keys[end] == keys[0]
                    yield take(end, True)
                    blocks = blocks + 1 if more else 0
                    continue
                end = at = 0  # whole groups of one kind, as many as fill a tile
                while at < len(keys) and kind(keys[at]) == kind(keys[0]):
                    after = at + 1
                    while after < len(keys) and keys[after] == keys[at]:
                        after += 1
                    if end and after > min(share, TILE) or after == len(keys) and not ended:
                        break
                    end = at = after
                yield take(end, False)

        for batch in batches:
            for own, column in zip((keys, words, ns), batch.columns, strict=True):
                own.extend(column.to_pylist())
            yield from settle(False)
        yield from settle(True)

    return run


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            yield _near(r["words"], r["ns"], r["others"], r["other_ns"], r["key"], r["same"])


def near_words(vocabulary: DataFrame, *, share: int = SHARE) -> DataFrame:
    """(word, other, other_n): both directions of every near pair of vocabulary(word, n), whose words are distinct. Groups of more than `share`
    words are compared by pairs of blocks."""
    small_batches(vocabulary.sparkSession)
    length = F.length("word")
    group = lambda side, m, part: F.concat(F.lit(side), m.cast("string"), F.lit(":"), part("word", F.floor(m / 2).cast("int")))
    keys = [group(side, m, part) for m in (length, length + 1) for side, part in (("p", F.left), ("s", F.right))]
    met = vocabulary.select(F.explode(F.array(*keys)).alias("key"), "word", "n").repartition("key").sortWithinPartitions("key", "word")
    found = cut(met.mapInArrow(_group_pairs(share), _FOUND))
    pairs = found.where("word is not null").select(*_PAIR)
    blocks = found.where("word is null").select("key", "block", "words", "ns")
    if blocks.isEmpty():
        return pairs
    x, y = blocks.alias("x"), blocks.alias("y")
    met = x.join(y, F.expr("x.key = y.key and x.block <= y.block"))
    met = met.select("x.words", "x.ns", F.col("y.words").alias("others"), F.col("y.ns").alias("other_ns"), "x.key", F.expr("x.block = y.block").alias("same"), F.xxhash64("x.key", "x.block", "y.block").alias("deal"))
    return pairs.union(met.repartition("deal").drop("deal").mapInArrow(_block_pairs, "word string, other string, other_n long"))


def group_variants(vocabulary: DataFrame, *, times: int = 10, share: int = SHARE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of vocabulary(word, n).

    form is the near word of the largest n, ties to the smallest word, if it has `times` the word's n or more, else null; root is what
    following forms ends at. Each step multiplies n by `times`, so the number of joins that double the steps is known beforehand.
    """
    if times < 2:
        raise ValueError("a form must have at least twice the word's number")
    vocabulary = cut(vocabulary.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    best = F.min(F.struct((-F.col("other_n")).alias("lead"), F.col("other").alias("form")))
    near = near_words(vocabulary, share=share).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = F.col("best.lead") <= -times * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.lead")).alias("form_n")
    )
    judged = cut(judged)
    most, least = vocabulary.agg(F.max("n"), F.min("n")).first()
    steps = math.log(max(1, most or 1) / max(1, least or 1), times)
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1.0, steps))) + 1):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
