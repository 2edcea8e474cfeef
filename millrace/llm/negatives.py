"""Hard negatives by slots: for each anchor and positive, the best rows of other labels within a share of the positive's score.

A score is the inner product of whole-numbered vectors. An anchor's positives are its best rows of its own label. Each positive opens a
window of scores between two shares of its own. The windows' upper limits, in descending order, cut the scores into disjoint slots; what
lies at or below a limit is its slot and all later ones, so the windows overlap but the slots do not. One pass over all rows keeps the k
best of each slot: every block of rows gives at most k a slot, partial limits combine them before the shuffle. Slots descend, so the best
of a window are the first k of its own slot's rows followed by those of later slots, down to the window's lower limit; one merge from
the last slot upwards answers all windows of an anchor. A row below every window is left out at once.

Rows and anchors travel as blocks of vectors. Each block of rows lies in one shard, each block of anchors goes to every shard; pairs of
blocks are multiplied as matrices, a pair at a time. Scores are exact: products of floats or doubles where all sums stay below 2^24 or 2^53, else of
64-bit or Python integers; a score beyond 64 bits is held at the largest or smallest one.

Defined results. Rows with a null label, id or vector, or a null or non-finite component, take no part. Missing components of shorter
vectors count as zero, empty vectors score zero. Equal scores go by the smaller id; rows that repeat are rows of their own, and so are
anchors. An anchor with fewer rows of its label has fewer positives, a window with fewer rows fewer negatives; without any it has no row.
Other columns are ignored, whatever their names. An empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Rows of a block, fewer if their vectors are long: BLOCK_BYTES of 64-bit components.
BLOCK, BLOCK_BYTES = 4096, 1 << 21
LARGEST = 2**63 - 1
_BLOCKS = "block int, low long, width int, kind string, rows binary, ids binary, labels binary, limits binary, vectors binary"
_NAMES = ["block", "low", "width", "kind", "rows", "ids", "labels", "limits", "vectors"]
_FOUND = "anchor long, slot int, score long, id long"


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, scale: float = 256) -> DataFrame:
    """(row, id, label, vector) of the rows that take part; components are floor(scale * x) as long. row tells equal ids apart."""
    x = lambda c: c.cast("double")
    sound = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(x(c)) < math.inf))
    whole = F.transform(vector_col, lambda c: F.floor(F.lit(float(scale)) * x(c)).cast("long"))
    found = rows.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound)
    return found.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vector"))


def _packed(most: int):
    """Reads (row, id, label, limits, vector); yields blocks of vectors padded to one width, in as few bytes a component as hold them."""

    def pack(k: int, held: list[tuple]) -> pa.RecordBatch:
        rows, ids, labels, limits, own = zip(*held, strict=True)
        vectors = np.zeros((len(own), max(map(len, own))), np.int64)
        for at, v in enumerate(own):
            vectors[at, : len(v)] = v
        size = max(np.min_scalar_type(int(x)).itemsize for x in (-1 - vectors.max(initial=0), vectors.min(initial=0)))
        plain = [np.array(x, np.int64).tobytes() for x in (rows, ids, labels, limits)]
        data = (k, rows[0], vectors.shape[1], f"<i{size}", *plain, vectors.astype(f"<i{size}").tobytes())
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.binary()] * 5)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(data, kinds, strict=True)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        k, width = 0, 1
        for batch in batches:
            ends = batch.column(4).offsets.to_numpy()
            values = batch.column(4).values.to_numpy(zero_copy_only=False)
            plain = [c.to_pylist() for c in batch.columns[:4]]
            for *r, begin, end in zip(*plain, ends[:-1], ends[1:], strict=True):
                wide = max(width, int(end - begin))
                if held and (len(held) == most or (len(held) + 1) * wide * 8 > BLOCK_BYTES):
                    yield pack(k, held)
                    held, k, wide = [], k + 1, max(1, int(end - begin))
                width = wide
                held.append((*r, values[begin:end]))
        if held:
            yield pack(k, held)

    return run


def packed(rows: DataFrame, *, most: int = BLOCK) -> DataFrame:
    """Blocks of at most `most` rows and BLOCK_BYTES of vectors, written to the shared folder; limits are packed where rows have them."""
    small_batches(rows.sparkSession)
    limits = "limits" if "limits" in rows.columns else F.array().cast("array<bigint>").alias("limits")
    return cut(rows.select("row", "id", "label", limits, "vector").mapInArrow(_packed(most), _BLOCKS))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered vectors, exact as long as they fit 64 bits, else held at the limits."""
    width = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :width], rows[:, :width]
    most = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    bound = most(a) * most(b) * width
    for most_exact, kind in ((2**24, np.float32), (2**53, np.float64), (LARGEST + 1, np.int64)):
        if bound < most_exact:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -LARGEST - 1, LARGEST).astype(np.int64)


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """Of the columns anchor, slot, score, id the k best of each anchor's slots, best first."""
    found = found[:, np.lexsort((found[3], -found[2], found[1], found[0]))]
    if not found.shape[1]:
        return found
    first = np.concatenate(([True], (found[:2, 1:] != found[:2, :-1]).any(axis=0)))
    at = np.arange(found.shape[1])
    return found[:, at - np.maximum.accumulate(np.where(first, at, 0)) < k]


def _pick(k: int, positives: bool):
    """Reads pairs of an anchor block and a row block; yields the k best rows of each anchor's slots. Pairs of one anchor block that come
    one after another are combined."""

    def one(r: dict) -> np.ndarray:
        ints = lambda c: np.frombuffer(r[c], np.int64)
        block = lambda x, n: np.frombuffer(r[f"{x}vectors"], r[f"{x}kind"]).reshape(n, r[f"{x}width"])
        keys, own_labels, rows, ids, labels = ints("a_rows"), ints("a_labels"), ints("rows"), ints("ids"), ints("labels")
        matrix = scores(block("a_", len(keys)), block("", len(rows)))
        limits = ints("a_limits").reshape(len(keys), -1)
        found = [np.zeros((4, 0), np.int64)]
        for at, key in enumerate(keys):
            score, alike = matrix[at], labels == own_labels[at]
            if positives:
                fit = np.flatnonzero(alike & (rows != key))
                if len(fit) > 8 * k:  # the k best and what ties with the last of them
                    fit = fit[score[fit] >= -np.partition(-score[fit], k - 1)[k - 1]]
                slots = np.zeros(len(fit), np.int64)
            else:
                low, upper = limits[at, 0], limits[at, 1:]  # upper limits descend
                fit = np.flatnonzero(~alike & (score >= low) & (score <= upper[0]))
                slots = len(upper) - np.searchsorted(upper[::-1], score[fit]) - 1  # the last limit that is not below the score
            found.append(_best(np.stack([np.full(len(fit), key), slots, score[fit], ids[fit]]), k))
        return np.concatenate(found, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, owner = np.zeros((4, 0), np.int64), None
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        out = lambda: pa.RecordBatch.from_arrays([pa.array(v, pa.int64()).cast(t) for v, t in zip(kept, kinds, strict=True)], ["anchor", "slot", "score", "id"])
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if owner != (r["a_low"], r["a_block"]):
                    yield out()
                    kept, owner = kept[:, :0], (r["a_low"], r["a_block"])
                kept = _best(np.concatenate((kept, one(r)), axis=1), k)
        yield out()

    return run


def _top(blocks: DataFrame, anchors: DataFrame, k: int, positives: bool) -> DataFrame:
    """(anchor, slot, score, id, at): the k best rows of each anchor's slots over all blocks, numbered from 1."""
    shards = max(1, min(blocks.count(), 2 * blocks.sparkSession.sparkContext.defaultParallelism))
    every = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    dealt = blocks.drop("limits").withColumn("shard", F.pmod(F.xxhash64("low", "block"), F.lit(shards)).cast("int"))
    found = every.join(dealt.hint("merge"), "shard").mapInArrow(_pick(k, positives), _FOUND)  # a merge gives an anchor block's pairs in a row
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)


def mine_negatives(
    rows: DataFrame, is_anchor: Column, *, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, most: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows(row, id, label, vector) of whole_vectors().

    A negative's score lies between low and high hundredths of the positive's, limits included. Positives' scores below zero have no
    window. Blocks hold at most `most` rows.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("shares must be 0 <= low <= high <= 100")
    rows = cut(rows)
    blocks, chosen = packed(rows, most=most), rows.where(is_anchor)
    few = min(most, 512)
    positives = cut(_top(blocks, packed(chosen, most=few), n_positives, True).where("score >= 0").select("anchor", "at", "score", "id"))
    # floor(high * p / 100) and ceil(low * p / 100) without products beyond 64 bits
    windows = positives.withColumn("upper", F.expr(f"score div 100 * {high} + score % 100 * {high} div 100"))
    windows = windows.withColumn("lower", F.expr(f"score div 100 * {low} + (score % 100 * {low} + 99) div 100"))
    # An anchor's upper limits in descending order, the last one repeated, behind the least lower limit.
    limits = windows.groupBy("anchor").agg(F.min("lower").alias("low"), F.reverse(F.array_sort(F.collect_list("upper"))).alias("u"))
    limits = limits.select(F.col("anchor").alias("row"), F.concat(F.array("low"), "u", F.array_repeat(F.element_at("u", -1), n_positives - F.size("u"))).alias("limits"))
    kept = _top(blocks, packed(chosen.join(limits, "row"), most=few), n_negatives, False)
    # The rows of an anchor's slots, at most n_negatives each, slot after slot: slots descend, so a window's merge is what stands from its own
    # slot on, cut after n_negatives and at its lower limit.
    line = kept.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("line"))
    suffix = F.slice(F.filter("line", lambda x: x["slot"] >= F.col("at") - 1), 1, n_negatives)
    answers = windows.join(line, "anchor").withColumn("negatives", F.filter(suffix, lambda x: -x["down"] >= F.col("lower")))
    each = answers.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode("negatives").alias("place", "x"))
    named = each.join(chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.down")).alias("negative_score"))
