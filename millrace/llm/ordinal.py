"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - score). One set of weights over hashed words, word beginnings and word shapes,
and over binned ratios of the whole text, is shared by all grades; ordered thresholds cut the score into grades.
A score gives the expected grade and the probability of each grade or a better one, by which texts are selected.

Training reads a bounded sample of graded rows (max_rows of each grade, texts of at most max_chars). Grading is one
narrow stage over whole texts with the broadcast weights, whose size is fixed.

Defined results. Null text counts as empty; a text without words has only its bins and is graded like any other.
Repeated rows are graded alike. With fewer than two grades among the sample every text gets that one grade. An id
under several grades teaches none. An empty table gives no row. Texts of any length are graded whole, and only their
sample is bounded. Other columns of the input are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches
from .vector import BYTES, SPACE, mix, range_hashes, word_spans

ROWS = 1 << 16
BINS = 16

# Classes of bytes in word shapes: capitals, other letters, digits; every other sign is its own class.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3


def text_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, row, value) of all features: every word in three hashed forms, weighted by the root of the text's length."""
    parts = [(x or "").encode() for x in texts]
    data = np.frombuffer(b" ".join([b"", *parts, b""]), np.uint8)
    edges = np.cumsum([1, *[len(x) + 1 for x in parts]])
    starts, ends = word_spans(~SPACE[data])
    first = np.searchsorted(starts, edges)
    n = np.diff(first)
    text = np.repeat(np.arange(len(texts)), n)
    word = range_hashes(BYTES[data], starts, ends)
    head = range_hashes(BYTES[data], starts, np.minimum(ends, starts + 4))
    kind = _CLASS[data]
    turn = np.concatenate(([True], kind[1:] != kind[:-1]))
    at = np.concatenate(([0], np.cumsum(turn)))
    shape = range_hashes(BYTES[kind[turn]], at[starts], np.maximum(at[ends], at[starts] + 1))
    forms = [mix(x + np.uint64(k)) & np.uint64(ROWS - 1) for k, x in enumerate((word, head, shape))]
    value = 1 / np.sqrt(np.maximum(1, n))[text]
    # Ratios of the whole text, one bin each: length, distinct words, capitals, signs, repeated words.
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[edges])
    size = np.maximum(1, total(~SPACE[data]))
    pair = np.unique(np.stack((text, word.view(np.int64))), axis=1)[0] if len(text) else text
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    ratios = [
        np.log2(1 + n) / 16,
        np.bincount(pair, minlength=len(texts)) / np.maximum(1, n),
        total(kind == 1) / size,
        total((kind > 3) & ~SPACE[data]) / size,
        np.bincount(text[again], minlength=len(texts)) / np.maximum(1, n),
    ]
    bins = [ROWS + k * BINS + np.minimum(BINS - 1, (r * BINS).astype(int)) for k, r in enumerate(ratios)]
    own = np.arange(len(texts))
    return (
        np.concatenate([text] * 3 + [own] * len(bins)).astype(np.int32),
        np.concatenate([x.astype(np.int32) for x in forms] + bins).astype(np.int32),
        np.concatenate([value] * 3 + [np.ones(len(texts))] * len(bins)).astype(np.float32),
    )


def scores(weights: np.ndarray, texts: list[str | None]) -> np.ndarray:
    text, row, value = text_features(texts)
    return np.bincount(text, weights[row] * value, minlength=len(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def tails(thresholds: np.ndarray, score: np.ndarray) -> np.ndarray:
    """P(grade > k) for every score and threshold k."""
    return _sigmoid(score[:, None] - thresholds[None])


def train(texts: list[str], grades: np.ndarray, *, steps: int = 200, rate: float = 0.05, penalty: float = 2e-5) -> dict:
    """Weights and ascending thresholds by penalised maximum likelihood. Grades are 0, 1, ..."""
    grades = np.asarray(grades, int)
    present = np.unique(grades)
    if len(present) < 2:
        return {"grade": int(present[0]) if len(present) else 0, "top": int(present[0]) if len(present) else 0}
    top = int(grades.max())
    # Features stay in parts of 200 texts, so no step makes an array over all of them.
    spans = [slice(at, min(len(texts), at + 200)) for at in range(0, len(texts), 200)]
    parts = [text_features(texts[x]) for x in spans]
    w = np.zeros(ROWS + 8 * BINS)
    # Thresholds are a first one and positive gaps, so they stay in order.
    free = np.concatenate(([-1.0], np.zeros(top - 1)))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(free), np.zeros_like(free)]
    share = np.bincount(grades, minlength=top + 1)
    balance = (len(grades) / np.maximum(1, len(present) * share))[grades]
    for t in range(1, steps + 1):
        gaps = np.exp(free[1:])
        cuts = np.concatenate(([free[0]], free[0] + np.cumsum(gaps)))
        s = np.concatenate([np.bincount(text, w[row] * value, minlength=x.stop - x.start) for x, (text, row, value) in zip(spans, parts, strict=True)])
        above = np.concatenate((np.ones((len(s), 1)), tails(cuts, s), np.zeros((len(s), 1))), axis=1)
        own = np.arange(len(s))
        high, low = above[own, grades], above[own, grades + 1]
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        slope = -(d_high - d_low) * balance / len(s)
        gw = penalty * w
        for x, (text, row, value) in zip(spans, parts, strict=True):
            gw += np.bincount(row, slope[x][text] * value, minlength=len(w))
        d_cut = np.zeros(top)
        np.add.at(d_cut, grades[grades > 0] - 1, (d_high * balance)[grades > 0] / len(s))
        np.add.at(d_cut, grades[grades < top], -(d_low * balance)[grades < top] / len(s))
        later = np.cumsum(d_cut[::-1])[::-1]
        gf = np.concatenate(([later[0]], later[1:] * gaps))
        for x, g, k in ((w, gw, 0), (free, gf, 2)):
            state[k] = 0.9 * state[k] + 0.1 * g
            state[k + 1] = 0.999 * state[k + 1] + 0.001 * g * g
            x -= rate * (state[k] / (1 - 0.9**t)) / (np.sqrt(state[k + 1] / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(free[1:])
    return {"weights": w, "cuts": np.concatenate(([free[0]], free[0] + np.cumsum(gaps))), "top": top}


def grade(model: dict, texts: list[str | None]) -> np.ndarray:
    """P(grade > k) of every text, a column for each k below the highest grade."""
    if "weights" not in model:
        return np.tile((np.arange(max(1, model["top"])) < model["grade"]).astype(float), (len(texts), 1))
    return tails(model["cuts"], scores(model["weights"], texts))


def graded_sample(docs: DataFrame, labels: DataFrame, rating: Column, *, max_rows: int = 1500, max_chars: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Texts and grades of at most max_rows rows of each grade 0, 1, 2, the first by a hash of their id among texts of at most max_chars.

    An id under two grades teaches none; of the rows of ids that repeat, at most six times max_rows are taken, in the order of that hash.
    """
    rated = labels.select(F.col("doc_id").alias("_id"), rating.cast("int").alias("_y")).where("_y between 0 and 2").groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_other"))
    rated = rated.where("_y = _other").select("_id", "_y")
    short = docs.where(F.length("text") <= max_chars).select(F.col("doc_id").alias("_id"))
    rated = cut(rated.join(short, "_id", "left_semi"))
    parts = [rated.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_rows) for y in range(3)]
    picked = F.broadcast(parts[0].union(parts[1]).union(parts[2]))  # at most three times max_rows rows of two numbers
    rows = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id")).where(F.length("text") <= max_chars)
    found = sorted(rows.select("doc_id", "text", "_y").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(6 * max_rows).collect())
    return [x.text for x in found], np.array([x._y for x in found], int)


def grade_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", *, at_least: int = 1, min_tail: float = 0.5) -> DataFrame:
    """(id, expected_grade, tail array<double>, kept) of every row: tail[k] is P(grade > k); kept if P(grade >= at_least) >= min_tail."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tail = grade(shared.value, batch.column(1).to_pylist())
            kept = tail[:, at_least - 1] >= min_tail
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tail.sum(axis=1)), pa.array(tail.tolist(), pa.list_(pa.float64())), pa.array(kept)], [id_col, "expected_grade", "tail", "kept"]
            )

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"`{id_col}` long, expected_grade double, tail array<double>, kept boolean")
