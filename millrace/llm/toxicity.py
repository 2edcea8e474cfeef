"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a hashed word embedding beside the mean of hashed embeddings of its byte trigrams, and with the
evidence that the labels of the training texts give for the word and for its strongest and mean run of four
characters, so spellings never seen before still resemble known ones. Two gated recurrent layers read a window of words from either end,
attention pools their states, one logistic unit scores the window. All overlapping windows of a text are scored
and the highest, calibrated on the training documents, is the text's score.

Training reads a bounded sample of labelled rows (max_rows of each label, texts of at most max_chars): first all
windows under their document's label, then, as only some windows of a toxic text are toxic, the highest window of
each document. Scoring is one narrow stage over whole texts with the broadcast network, whose size is fixed.

Defined results. Null text counts as empty; a text without words scores 0. Repeated rows score alike. Without
labelled rows of both kinds every score is the share of toxic labels (0 without any). An id under both labels
teaches neither. An empty table gives no row. Texts of any length are scored whole, window after window, and only
their sample is bounded. Other columns of the input are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches
from .vector import mix, range_hashes, word_spans

WINDOW, STRIDE = 32, 16
WORD_ROWS, CHAR_ROWS, RUN_ROWS, WIDTH, HIDDEN = 1 << 16, 1 << 13, 1 << 17, 8, 8
INPUTS = 2 * WIDTH + 3
#: Deviations by which a word or run must exceed chance before it counts as evidence.
CHANCE = 2.5
#: Windows scored at once.
CHUNK = 4096

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), 39, *range(128, 256)]] = True
_VALUE = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)


class Words:
    """The words of some texts as arrays: runs of letters, digits and non-ASCII signs, lower case."""

    def __init__(self, texts: list[str | None]) -> None:
        parts = [(x or "").lower().encode() for x in texts]
        data = np.frombuffer(b" ".join([b"", *parts, b""]), np.uint8)
        edges = np.cumsum([1, *[len(x) + 1 for x in parts]])
        self.starts, self.ends = word_spans(_LETTER[data])
        self.first = np.searchsorted(self.starts, edges)
        values = _VALUE[data]
        self.bucket = (range_hashes(values, self.starts, self.ends) & np.uint64(WORD_ROWS - 1)).astype(np.int32)
        kept = np.where(_LETTER[data], values, np.uint64(0))  # beside a word every sign is the same border
        near = np.zeros(len(data), np.uint64)
        near[1:-1] = kept[:-2] * np.uint64(3) + kept[1:-1] * np.uint64(5) + kept[2:] * np.uint64(7)
        self.trigram = (mix(near) & np.uint64(CHAR_ROWS - 1)).astype(np.int32)
        near[:-2] += kept[2:] * np.uint64(11)
        self.run = (mix(near) & np.uint64(RUN_ROWS - 1)).astype(np.int32)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, words) of every window; a text with words has at least one."""
        n = np.diff(self.first)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        doc = np.repeat(np.arange(len(n)), count)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = self.first[doc] + STRIDE * number
        return doc, start, np.minimum(WINDOW, self.first[doc + 1] - start)

    def inputs(self, net: dict, words: np.ndarray, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of some words, and the trigrams and lengths behind them. held: 0 or 1, embeddings to use."""
        starts = self.starts[words]
        length = self.ends[words] - starts
        head = np.cumsum(length) - length
        at = np.repeat(starts - head, length) + np.arange(length.sum())
        trigrams, runs = self.trigram[at], net["runs"][self.run[at]]
        mean = np.add.reduceat(net["chars"][trigrams], head, axis=0) / length[:, None]
        own = net["words"][self.bucket[words]]
        if held is not None:
            own, mean = own * held[:, :1], mean * held[:, 1:]
        most, all_ = np.maximum.reduceat(runs, head), np.add.reduceat(runs, head) / length
        into = np.concatenate((own, mean, net["seen"][self.bucket[words]][:, None], most[:, None], all_[:, None]), axis=1)
        return into.astype(np.float32), trigrams, length


def evidence(rows: int, ids: np.ndarray, doc: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """By row of a hashed table, how far its share of toxic documents exceeds chance, in deviations beyond CHANCE."""
    pairs = np.unique(ids.astype(np.int64) * len(labels) + doc)
    of, y = pairs // len(labels), labels[pairs % len(labels)]
    count, toxic = np.bincount(of, minlength=rows), np.bincount(of, y, minlength=rows)
    expected = count * labels.mean()
    deviation = (toxic - expected) / np.sqrt(expected + 1)
    return (np.sign(deviation) * np.maximum(0, np.abs(deviation) - CHANCE)).clip(-4, 12).astype(np.float32) / 4


def without_copies(texts: list[str], sketch: int = 8) -> list[int]:
    """Numbers of the texts that share less than half of their sketch of word shingles with earlier ones."""
    seen: set[int] = set()
    kept = []
    for i, x in enumerate(texts):
        words = Words([x])
        one = mix(words.bucket.astype(np.uint64) + np.uint64(1))
        n = len(one) - 4
        marks = np.sort(mix(sum(one[k : n + k] * np.uint64(2 * k + 3) for k in range(5))))[:sketch].tolist() if n > 0 else one.tolist()
        if marks and 2 * sum(m in seen for m in marks) < len(marks):
            kept.append(i)
        seen.update(marks)
    return kept


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_net(seed: int = 5) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: (draw.standard_normal(shape) * 0.3).astype(np.float32)
    return {
        "words": np.zeros((WORD_ROWS, WIDTH), np.float32),
        "chars": normal(CHAR_ROWS, WIDTH),
        "seen": np.zeros(WORD_ROWS, np.float32),
        "runs": np.zeros(RUN_ROWS, np.float32),
        "x": normal(2, INPUTS, 3 * HIDDEN),
        "h": normal(2, HIDDEN, 3 * HIDDEN),
        "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "a": normal(2 * HIDDEN, HIDDEN),
        "ab": np.zeros(HIDDEN, np.float32),
        "av": normal(HIDDEN),
        "o": normal(2 * HIDDEN),
        "ob": np.zeros(1, np.float32),
    }


def forward(net: dict, into: np.ndarray, index: np.ndarray, size: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows. into: input vectors; index: their rows by window and step; size: steps that count."""
    n, steps = index.shape
    gates = np.matmul(into[None], net["x"]) + net["b"]
    live = np.arange(steps)[None, :] < size[:, None]
    state = np.zeros((2, n, HIDDEN), np.float32)
    states = np.zeros((2, steps, n, HIDDEN), np.float32)
    for t in range(steps):
        at = (t, steps - 1 - t)
        g = np.stack((gates[0][index[:, at[0]]], gates[1][index[:, at[1]]]))
        m = np.stack((live[:, at[0]], live[:, at[1]]))[:, :, None]
        u = np.matmul(state, net["h"])
        zr = _sigmoid(g[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        new = np.tanh(g[..., 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
        after = np.where(m, z * state + (1 - z) * new, state)
        if keep is not None:
            keep.append((at, m, state, u, z, r, new))
        state = after
        states[0, at[0]], states[1, at[1]] = state[0], state[1]
    both = np.concatenate((states[0], states[1]), axis=2)
    inner = np.tanh(both @ net["a"] + net["ab"])
    weight = np.where(live.T, inner @ net["av"], -1e9)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * both).sum(axis=0)
    if keep is not None:
        keep.append((both, inner, weight, pooled))
    return pooled @ net["o"] + net["ob"][0]


def backward(net: dict, into: np.ndarray, index: np.ndarray, keep: list, slope: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the dense parts and of the input vectors; slope: of the loss by each logit."""
    both, inner, weight, pooled = keep[-1]
    grad = {"o": pooled.T @ slope, "ob": np.array([slope.sum()], np.float32)}
    d_pool = slope[:, None] * net["o"]
    d_both = weight[:, :, None] * d_pool[None]
    d_weight = (both * d_pool[None]).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["av"] = np.einsum("tnk,tn->k", inner, d_score)
    d_inner = d_score[:, :, None] * net["av"] * (1 - inner**2)
    grad["a"], grad["ab"] = np.einsum("tnj,tnk->jk", both, d_inner), d_inner.sum(axis=(0, 1))
    d_both += d_inner @ net["a"].T
    grad["h"], d_gates = np.zeros_like(net["h"]), np.zeros((2, len(into), 3 * HIDDEN), np.float32)
    d_state = np.zeros_like(keep[0][2])
    for at, m, state, u, z, r, new in reversed(keep[:-1]):
        d_state = d_state + np.stack((d_both[at[0], :, :HIDDEN], d_both[at[1], :, HIDDEN:]))
        d_after = np.where(m, d_state, 0)
        d_new = d_after * (1 - z) * (1 - new**2)
        d_zr = np.concatenate((d_after * (state - new) * z * (1 - z), d_new * u[..., 2 * HIDDEN :] * r * (1 - r)), axis=2)
        d_u = np.concatenate((d_zr, d_new * r), axis=2)
        d_g = np.concatenate((d_zr, d_new), axis=2)
        grad["h"] += np.matmul(state.transpose(0, 2, 1), d_u)
        for k in (0, 1):
            np.add.at(d_gates[k], index[:, at[k]], d_g[k])
        d_state = np.where(m, d_after * z, d_state) + np.matmul(d_u, net["h"].transpose(0, 2, 1))
    grad["b"] = d_gates.sum(axis=1, keepdims=True)
    grad["x"] = np.matmul(into.T[None], d_gates)
    return grad, np.matmul(d_gates, net["x"].transpose(0, 2, 1)).sum(axis=0)


class Adam:
    def __init__(self, net: dict, rate: float) -> None:
        self.net, self.rate, self.t = net, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in net.items()} for _ in range(2))

    def step(self, grad: dict) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grad.items():
            rows, rate = slice(None), scale
            if isinstance(g, tuple):  # some rows of a table: slower, and drawn to zero
                rows, g, rate = g[0], g[1] + 1e-4 * self.net[k][g[0]], scale / 5
            self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * g
            self.v[k][rows] = 0.999 * self.v[k][rows] + 0.001 * g * g
            self.net[k][rows] -= (rate * self.m[k][rows] / (np.sqrt(self.v[k][rows]) + 1e-6)).astype(np.float32)


def _learn(net: dict, adam: Adam, words: Words, start: np.ndarray, size: np.ndarray, label: np.ndarray, draw, stuck: int = 0) -> None:
    """One step on a batch of windows, the last `stuck` of them read as their first word over and over; half of the embeddings are left out, so none is relied upon alone."""
    index = np.minimum(start[:, None] + np.arange(WINDOW), (start + size - 1)[:, None])
    if stuck:
        index[-stuck:] = start[-stuck:, None]
        size = np.concatenate((size[:-stuck], np.full(stuck, WINDOW)))
    used, rows = np.unique(index, return_inverse=True)
    rows = rows.reshape(index.shape)
    held = (draw.random((len(used), 2)) > 0.5).astype(np.float32)
    into, chars, length = words.inputs(net, used, held)
    keep: list = []
    slope = (_sigmoid(forward(net, into, rows, size, keep)) - label) / len(label)
    grad, d_into = backward(net, into, rows, keep, slope.astype(np.float32))
    for name, ids, d in (("words", words.bucket[used], d_into[:, :WIDTH] * held[:, :1]), ("chars", chars, np.repeat(d_into[:, WIDTH : 2 * WIDTH] * held[:, 1:] / length[:, None], length, axis=0))):
        row, place = np.unique(ids, return_inverse=True)
        total = np.zeros((len(row), WIDTH), np.float32)
        np.add.at(total, place, d.astype(np.float32))
        grad[name] = (row, total)
    adam.step(grad)


def window_logits(net: dict, words: Words, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logits of windows in ascending order of their first word."""
    out = np.zeros(len(start), np.float32)
    for at in range(0, len(start), CHUNK):
        s, n = start[at : at + CHUNK], size[at : at + CHUNK]
        a, b = int(s[0]), int((s + n).max())
        index = np.minimum(s[:, None] + np.arange(WINDOW), (s + n - 1)[:, None]) - a
        out[at : at + CHUNK] = forward(net, words.inputs(net, np.arange(a, b))[0], index, n)
    return out


def text_logits(net: dict, texts: list[str | None]) -> np.ndarray:
    """Highest window logit of every text; -inf without words."""
    words = Words(texts)
    doc, start, size = words.windows()
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, doc, window_logits(net, words, start, size))
    return best


def credible(logit: np.ndarray, labels: np.ndarray, share: float = 0.9) -> np.ndarray:
    """False for documents labelled toxic that score no higher than most clean ones: labels hold mistakes, and learning
    them by heart would raise the scores of clean texts. True for all if that leaves too few."""
    toxic = labels == 1
    if not toxic.any() or toxic.all():
        return np.ones(len(labels), bool)
    kept = ~toxic | (logit > np.quantile(logit[~toxic], share))
    return kept if 4 * (kept & toxic).sum() >= toxic.sum() else np.ones(len(labels), bool)


def train(texts: list[str], labels: np.ndarray, *, seed: int = 5, steps: int = 250, rounds: int = 4, batch: int = 192, rate: float = 0.01) -> dict:
    """A network from labelled texts, calibrated on the quarter of them that it did not learn from."""
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        return {"prior": float(labels.mean()) if len(labels) else 0.0}
    every = without_copies(texts)
    aside = every[3::4]
    texts_aside, labels_aside = [texts[i] for i in aside], labels[aside]
    learned = [i for i in every if i not in set(aside)]
    texts, labels = [texts[i] for i in learned], labels[learned]
    draw, net = np.random.default_rng(seed), new_net(seed)
    adam, words = Adam(net, rate), Words(texts)
    doc, start, size = words.windows()
    of = labels[doc]
    sides = [np.flatnonzero(of == y) for y in (0, 1)]
    if not all(map(len, sides)):
        return {"prior": float(labels.mean())}
    word_doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    net["seen"] = evidence(WORD_ROWS, words.bucket, word_doc, labels)
    length = words.ends - words.starts
    at = np.repeat(words.starts - np.cumsum(length) + length, length) + np.arange(length.sum())
    net["runs"] = evidence(RUN_ROWS, words.run[at], np.repeat(word_doc, length), labels)

    def balanced(n, sides):
        """n windows, then an eighth as many clean ones for stuck words, which many clean texts hold."""
        return np.concatenate([*[draw.choice(s, n // 2) for s in sides], draw.choice(quiet, n // 8)])

    quiet = sides[0][net["seen"][words.bucket[start[sides[0]]]] <= 0]

    for _ in range(steps):
        pick = balanced(batch, sides)
        _learn(net, adam, words, start[pick], size[pick], of[pick], draw, batch // 8)
    for k in range(rounds):
        adam.rate = rate * 0.6**k
        logit = window_logits(net, words, start, size)
        order = np.lexsort((logit, doc))
        top = order[np.flatnonzero(np.diff(doc[order], append=-1))]  # the highest window of each document
        high = [top[of[top] == y] for y in (0, 1)]
        high[1] = high[1][credible(logit[top], of[top])[of[top] == 1]]
        for _ in range(40):
            pick = np.concatenate((draw.choice(sides[0], batch // 4), balanced(batch, high)))
            _learn(net, adam, words, start[pick], size[pick], of[pick], draw, batch // 8)
    best = text_logits(net, texts_aside)
    seen = np.isfinite(best)
    x, y = best[seen], labels_aside[seen]
    x, y = x[kept := credible(x, y)], y[kept]
    slope, shift = 1.0, 0.0
    for _ in range(50):  # logistic calibration with a weak prior
        p = _sigmoid(slope * x + shift)
        w = p * (1 - p) + 1e-4
        grad = np.array([((p - y) * x).sum() + 0.1 * (slope - 1), (p - y).sum()])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        move = np.clip(np.linalg.solve(hess, grad), -1, 1)
        slope, shift = slope - move[0], shift - move[1]
    return {"net": net, "slope": float(slope), "shift": float(shift)}


def score_texts(model: dict, texts: list[str | None]) -> np.ndarray:
    if "net" not in model:
        return np.array([model["prior"] if x and Words([x]).first[-1] else 0.0 for x in texts])
    best = text_logits(model["net"], texts)
    return np.where(np.isfinite(best), _sigmoid(model["slope"] * np.where(np.isfinite(best), best, 0) + model["shift"]), 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, *, max_rows: int = 1500, max_chars: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most max_rows rows of each label, the first by a hash of their id among texts of at most max_chars.

    An id under both labels teaches neither; of the rows of ids that repeat, at most four times max_rows are taken, in the order of that hash.
    """
    short = docs.where(F.length("text") <= max_chars).select(F.col("doc_id").alias("_id"))
    marked = labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.min("toxic").alias("_y"), F.max("toxic").alias("_other"))
    marked = cut(marked.where("_y = _other").select("_id", "_y").join(short, "_id", "left_semi"))
    parts = [marked.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_rows) for y in (0, 1)]
    picked = F.broadcast(parts[0].union(parts[1]))  # at most twice max_rows rows of two numbers
    rows = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id")).where(F.length("text") <= max_chars)
    found = sorted(rows.select("doc_id", "text", "_y").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(4 * max_rows).collect())
    return [x.text for x in found], np.array([x._y for x in found], np.float32)


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"`{id_col}` long, score double")
