"""Benchmark decontamination with spaced seeds.

A mask selects some positions of a stretch of words and ignores the others, so stretches that differ there still
hash alike. Test items and training texts are hashed under every mask; equal hashes join; around each hit the
text is laid along the item and the best stretch with few substitutions is measured word by word.

Texts are hashed where they are read. A bitmap of the items' hashes, of at most 2^MOST_BITS bits whatever their
number, lets through what may hit; clusters of such hits travel on with as many words around them as the longest item
has, so an item is laid along the text in its whole length, and an ordinary join with the items' hashes, which the
planner broadcasts or shuffles by size, decides. Nothing else grows with the benchmark on the driver or in a broadcast.

Items shorter than `min_words` leave no room for substitutions: the hash of all their words is looked up at every place
of a text, and they are leaks where they stand word for word.

Defined results. Words are runs of letters, digits, apostrophes and non-ASCII signs, A-Z and all other capitals
lowered. Null texts and items count as empty. Items of fewer than `least_words` words (a parameter; 1 takes every item)
say nothing about a text and match nothing. Repeated rows, of either table, give one row for each pair of ids. Empty
tables give an empty result; other columns of the inputs are ignored. Long texts are hashed whole, in memory that grows
with the batch of some 2 MB of text, or with one text beyond that.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, cut, keyed, small_batches
from .toxicity import Words
from .vector import mix, word_hashes

#: Selected (1) and ignored (0) positions.
MASKS = ("1110111", "110101011", "1101100011", "10110100111")
#: The bitmap of item hashes has 2 to a power of bits in this range, at least 64 bits a hash below the bound; a hash sets two of them.
LEAST_BITS, MOST_BITS = 24, 28


class Stretches(Words):
    """Words of some texts with their hashes and seeds."""

    def __init__(self, texts: list[str | None]) -> None:
        super().__init__(texts)
        data = np.frombuffer(b" ".join([b"", *[(x or "").lower().encode() for x in texts], b""]), np.uint8)
        self.word = word_hashes(data, self.starts, self.ends)

    def seeds(self, masks: tuple[str, ...] = MASKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per mask: first words of the stretches inside one text, and their hashes."""
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        for k, mask in enumerate(masks):
            n = len(self.word) - len(mask) + 1
            if n <= 0:
                continue
            at = np.flatnonzero(doc[:n] == doc[len(mask) - 1 :])
            total = np.full(len(at), np.uint64(k if mask in MASKS else len(mask) + 64))
            for j, sign in enumerate(mask):
                if sign == "1":
                    total = mix(total * np.uint64(0x9E3779B97F4A7C15) + self.word[at + j])
            yield at, total


def item_seeds(items: DataFrame, id_col: str, text_col: str, least_words: int, min_words: int) -> DataFrame:
    """(item_id, n, words array<long>, seeds array<struct<hash, at>>) of every item of least_words or more. An item of fewer than
    min_words has one seed, of all its words."""
    small_batches(items.sparkSession)
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))

    def run(batches):
        for batch in batches:
            s = Stretches(batch.column(1).to_pylist())
            found = [[] for _ in range(batch.num_rows)]
            sizes = np.diff(s.first)
            for n, seeds in [(0, s.seeds()), *((n, s.seeds(("1" * n,))) for n in range(1, min_words))]:
                for at, hashes in seeds:
                    of = np.searchsorted(s.first, at, "right") - 1
                    keep = sizes[of] == n if n else sizes[of] >= min_words
                    for i, a, h in zip(of[keep].tolist(), at[keep].tolist(), hashes[keep].view(np.int64).tolist(), strict=True):
                        found[i].append({"hash": h, "at": a - int(s.first[i])})
            words = [s.word[a:b].view(np.int64) for a, b in zip(s.first[:-1], s.first[1:], strict=True)]
            keep = np.flatnonzero(sizes >= least_words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep)),
                    pa.array(sizes[keep], pa.int32()),
                    pa.array([words[i] for i in keep], pa.list_(pa.int64())),
                    pa.array([found[i] for i in keep], kind),
                ],
                ["item_id", "n", "words", "seeds"],
            )

    slim = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return cut(slim.mapInArrow(run, "item_id long, n int, words array<long>, seeds array<struct<hash: long, at: int>>"))


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bitmap of two runs of bits of seeds(hash), sized by their number. What reaches the driver are its words of 32 bits that are
    not zero, at most 2^MOST_BITS bits whatever the input; beyond that size the bitmap lets more through and the join decides."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * seeds.count()).bit_length()))
    place = lambda shift: F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit((1 << bits) - 1))
    places = seeds.select(F.explode(F.array(place(0), place(bits))).alias("place"))
    packed = places.groupBy(F.shiftright("place", 5).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 31 as int)))").alias("bits"))
    table = np.zeros(1 << (bits - 5), np.uint32)
    for batch in packed.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint32)
    return table.astype("<u4").view(np.uint8)


def may_hit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes whose two places are both set."""
    found, bits = np.arange(len(hashes)), (8 * len(bitmap)).bit_length() - 1
    for shift in (0, bits):
        place = (hashes[found] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        found = found[(bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return found


def text_clusters(docs: DataFrame, id_col: str, text_col: str, bitmap: np.ndarray, around: int, short: tuple[int, ...]) -> DataFrame:
    """(cluster, doc_id, from, words array<long>, seeds array<struct<hash, at>>): hits of the bitmap less than `around` words apart, with
    as many words on either side. short: numbers of words of items that are looked up whole."""
    masks = MASKS + tuple("1" * n for n in short)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))
    schema = pa.schema([("cluster", pa.string()), ("doc_id", pa.int64()), ("from", pa.int64()), ("words", pa.list_(pa.int64())), ("seeds", kind)])

    def run(batches):
        for batch in batches:
            s = Stretches(batch.column(1).to_pylist())
            ids = batch.column(0).to_pylist()
            hits = [(at[k], h[k]) for at, h in s.seeds(masks) for k in [may_hit(shared.value, h)]]
            if not hits:
                continue
            at, h = (np.concatenate(x) for x in zip(*hits, strict=True))
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            of = np.searchsorted(s.first, at, "right") - 1
            far = np.flatnonzero((np.diff(at) > around) | (np.diff(of) > 0)) + 1
            rows, tag = [], uuid.uuid4().hex
            for k, (a, b) in enumerate(zip([0, *far.tolist()], [*far.tolist(), len(at)], strict=True)):
                if a == b:
                    continue
                i = int(of[a])
                begin = max(int(s.first[i]), int(at[a]) - around)
                end = min(int(s.first[i + 1]), int(at[b - 1]) + around + max(map(len, masks)))
                seeds = [{"hash": x, "at": y - begin} for x, y in zip(h[a:b].view(np.int64).tolist(), at[a:b].tolist(), strict=True)]
                rows.append({"cluster": f"{tag}-{k}", "doc_id": ids[i], "from": begin - int(s.first[i]), "words": s.word[begin:end].view(np.int64).tolist(), "seeds": seeds})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return cut(slim.mapInArrow(run, "cluster string, doc_id long, `from` long, words array<long>, seeds array<struct<hash: long, at: int>>"))


def best_stretch(same: np.ndarray, penalty: int) -> tuple[int, int, int]:
    """(matches, from, to) of the stretch with the highest sum of 1 for a match and -penalty for a substitution."""
    total = np.concatenate(([0], np.cumsum(np.where(same, 1, -penalty))))
    low = np.minimum.accumulate(total)
    to = int(np.argmax(total - low))
    begin = int(np.argmax(total[: to + 1] == low[to]))
    return int(same[begin:to].sum()), begin, to


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_words: int = 4,
    min_words: int = 8,
    min_share: float = 0.5,
    long_item: int = 40,
    penalty: int = 2,
) -> DataFrame:
    """(doc_id, item_id, n_matched, n_item_words, n_stretch, word_from) of every text that holds a stretch of an item.

    A pair is a leak if the best stretch along a hit matches at least min_words words and min_share of the item's
    (of long_item words in longer items), or all words of an item of fewer than min_words. penalty 2 admits a
    substitution for every two matches before it.
    """
    searched = item_seeds(items, item_id, item_text, least_words, min_words)
    sizes = searched.agg(F.max("n").alias("most"), F.array_sort(F.collect_set(F.when(F.col("n") < min_words, F.col("n")))).alias("short")).first()
    seeds = searched.select("item_id", F.inline("seeds"))
    clusters = text_clusters(docs, doc_id, doc_text, seed_filter(seeds), sizes.most or 1, tuple(sizes.short))
    hits = clusters.select("cluster", F.inline("seeds")).withColumnRenamed("at", "text_at")
    lines = hits.join(seeds, "hash").select("cluster", "item_id", (F.col("text_at") - F.col("at")).alias("shift")).distinct()
    pairs = lines.join(clusters.drop("seeds"), "cluster").join(
        searched.select(F.col("item_id").alias("i_id"), "n", F.col("words").alias("item_words")), F.expr("item_id <=> i_id")
    )
    schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "item_id", "n_matched", "n_item_words", "n_stretch", "word_from")])

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, item = np.array(r["words"]), np.array(r["item_words"])
                a, b = max(0, r["shift"]), min(len(text), r["shift"] + len(item))
                matches, begin, to = best_stretch(text[a:b] == item[a - r["shift"] : b - r["shift"]], penalty)
                if matches >= min(len(item), max(min_words, min_share * min(len(item), long_item))):
                    rows.append({"doc_id": r["doc_id"], "item_id": r["item_id"], "n_matched": matches, "n_item_words": len(item), "n_stretch": to - begin, "word_from": r["from"] + a + begin})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    found = pairs.select("doc_id", "item_id", "shift", "from", "words", "item_words").mapInArrow(
        run, "doc_id long, item_id long, n_matched long, n_item_words long, n_stretch long, word_from long"
    )
    best = F.max(F.struct("n_matched", -F.col("word_from"), "n_item_words", "n_stretch", "word_from"))
    picked = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return picked.select(F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), "b.n_matched", "b.n_item_words", "b.n_stretch", "b.word_from")


def drop_leaks(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """docs without the texts that hold a stretch of an item. Rows are told apart by a key of their own, never by id."""
    rows = keyed(docs)
    leaks = find_leaks(rows, items, **how | {"doc_id": ROW}).select(ROW).distinct()
    return rows.join(leaks, ROW, "left_anti").select(*docs.columns)
