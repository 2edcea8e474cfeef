"""Near-duplicates by true shingle similarity: SimHash and then MinHash bands propose pairs, the whole shingle sets decide.

Two texts link when the Jaccard similarity of their sets of word shingles reaches a threshold. Texts of equal sets are one node.
Every text gets the SimHash of its shingles, and fingerprints at most LIMIT bits apart meet by multi-index hashing, as in simhash.
At 0.8 most pairs lie further apart than that, so what SimHash does not propose is found by MinHash: a text's set gets
BANDS keys of ROWS minima each; a pair of similarity s shares a key with probability 1 - (1 - s^ROWS)^BANDS, which
is 1 - 3e-6 at 0.8. Nodes under one key meet the key's lead, the node with the least
share of shingles that no other node has, then one node of another component, so large groups join by few pairs. What is then
still in two components under a key is compared whole, in blocks: 0-1 matrices of nodes and shingles, whose products are the sizes of
all intersections; only pairs that join components become rows. A shingle that no other node has is in no intersection, so the counts
alone rule out pairs, and nodes, of edited copies. Only the sets of texts that share a key, or are near by SimHash, travel.

Defined results. Null text counts as empty; all texts without words have the same empty set and are copies of each
other. A text of fewer words than a shingle is one shingle; texts of any length are read whole. Rows are told apart by a key
of their own, never by id. An empty table gives an empty one. All columns of the input stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, cut, first_rows, keyed, small_batches
from .graph import components
from .simhash import fingerprint_links, majority_bits, shingle_hashes

#: Bits in which fingerprints of a proposed pair may differ.
LIMIT = 4
ROWS = 5
BANDS = 32
#: Pairs of one text are spread over so many copies of its set.
SPREAD = 64
#: Nodes of a block that is compared at once, and its shingles.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
_DRAW = np.random.default_rng(5)
_FLIP = _DRAW.integers(0, 2**64, ROWS * BANDS, dtype=np.uint64)
_TIMES = _DRAW.integers(0, 2**64, ROWS * BANDS, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, size), np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of minima of a shingle set."""
    least = np.full(ROWS * BANDS, np.uint64(2**64 - 1))
    for at in range(0, len(hashes), 1024):
        part = hashes[at : at + 1024]
        np.minimum(least, ((part[None] ^ _FLIP[:, None]) * _TIMES[:, None]).min(axis=1), out=least)
    data = least.tobytes()
    step = 8 * ROWS
    keys = [xxhash.xxh64_intdigest(data[k * step : (k + 1) * step], k) for k in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(row, id, whole, n, keys, fp): hash and size of the shingle set of every row of keyed docs, its band keys and its fingerprint."""
    small_batches(docs.sparkSession)
    names = ["row", "id", "whole", "n", "keys", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.array(shingle_hashes(x.as_py(), size), np.uint64) for x in batch.column(2)]
            sets = [np.unique(x) for x in hashes]
            fp = pa.array(np.array([majority_bits(x) for x in hashes], np.uint64).view(np.int64))
            whole = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary())
            keys = pa.array([band_keys(x) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), whole, pa.array([len(x) for x in sets], pa.int64()), keys, fp], names)

    slim = docs.select(F.col(ROW).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "row long, id long, whole binary, n long, keys array<long>, fp long")


def shingle_sets(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """(node, shingles) of keyed docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py(), size).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return docs.select(F.col(ROW).alias("node"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "node long, shingles array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs(a, b) whose sets are similar. A node of many pairs has copies of its set, so its pairs spread over tasks."""
    for own, other in (("a", "b"), ("b", "a")):
        pairs = pairs.withColumn(f"at_{own}", F.pmod(F.xxhash64(other), F.lit(SPREAD)))
        copies = pairs.select(own, f"at_{own}").distinct().join(sets.select(F.col("node").alias(own), F.col("shingles").alias(f"set_{own}")), own)
        pairs = pairs.join(copies, [own, f"at_{own}"])
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.where(both >= F.lit(similarity) * (F.size("set_a") + F.size("set_b") - both) - 1e-9).select("a", "b")


def near_by_simhash(heads: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a < b: pairs of heads(node, n, fp) by SimHash whose sizes allow the similarity. Nodes of one fingerprint meet the least of them,
    and that one those of the fingerprints at most LIMIT bits away, by links of the same components as all such pairs."""
    least = cut(heads.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("x")).select("fp", "x.*"))
    side = lambda s: least.select(F.col("fp").alias(s), F.col("node").alias(f"node_{s}"), F.col("n").alias(f"n_{s}"))
    apart = fingerprint_links(least.select("fp"), LIMIT).distinct().join(side("a"), "a").join(side("b"), "b")
    equal = heads.select("fp", F.col("node").alias("node_a"), F.col("n").alias("n_a")).join(side("fp_b").withColumnRenamed("fp_b", "fp"), "fp").where("node_a <> node_fp_b")
    ends = ("node_a", "n_a", "node_b", "n_b")
    pairs = apart.select(*ends).union(equal.select("node_a", "n_a", "node_fp_b", "n_fp_b")).where(F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b") - 1e-9)
    return cut(pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct())


def similar_links(heads: DataFrame, sets_of, similarity: float, block: int = BLOCK) -> DataFrame:
    """(a, b): links whose components are those of all pairs of heads(node, n, keys, fp) that share a key or are near by SimHash and are similar.

    sets_of(nodes) gives (node, shingles) of nodes(node). Of fingerprints that lie near each other the links are compared, not all pairs.
    """
    near = near_by_simhash(heads, similarity)
    met = heads.select("node", "n", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sharing = cut(met.join(shared.select("key"), "key"))
    sets = cut(sets_of(sharing.select("node").union(near.select("a")).union(near.select("b")).distinct()))
    met_once = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
    lone = met_once.groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
    members = cut(sharing.join(lone, "node", "left").select("key", "node", "n", F.coalesce("lone", F.lit(0)).alias("lone")))
    own = lambda x: F.col(f"{x}n") - F.col(f"{x}lone")

    def fits(x: str, y: str) -> Column:
        """Whether the counts of two nodes, columns of these prefixes, allow the similarity."""
        both = F.least(own(x), own(y))
        return both >= F.lit(similarity) * (F.col(f"{x}n") + F.col(f"{y}n") - both) - 1e-9

    ends = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    lead = members.groupBy("key").agg(F.min(F.struct((F.col("lone") / F.greatest("n", F.lit(1))).alias("share"), "node", "n", "lone")).alias("lead"))
    met_lead = members.join(lead, "key").where((F.col("node") != F.col("lead.node")) & fits("", "lead."))
    tried = cut(near.union(met_lead.select(*ends(F.col("node"), F.col("lead.node")))).distinct())
    links = cut(_similar(tried, sets, similarity))
    # Of a key with two nodes one is the lead, so their pair has been compared or ruled out.
    members = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 2").select("key"), "key", "left_semi")
    apart, split = _apart(members, links)
    if apart.isEmpty():
        return links
    # One more try by a node of another component, then all of them: blocks of a key's nodes are compared as matrices.
    other = apart.join(split.select("key", "lead"), "key").where((F.col("root") != F.col("lead.root")) & fits("", "lead."))
    found = cut(other.select(*ends(F.col("node"), F.col("lead.node"))).distinct().join(tried, ["a", "b"], "left_anti"))
    links = links.union(cut(_similar(found, sets, similarity)))
    apart, _ = _apart(members.where(own("") >= F.lit(similarity) * F.col("n") - 1e-9), links)
    return links.union(_similar_in_blocks(apart, sets, similarity, block))


def _apart(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members, with root, of keys that are still in two components of links; per such key a lead, drawn by a hash."""
    rooted = members.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lead = F.min(F.struct(F.xxhash64("key", "node"), "node", "n", "lone", "root")).alias("lead")
    split = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), lead).where("low <> high")
    return cut(rooted.join(split.select("key"), "key", "left_semi")), split


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of x with each of y, by products of 0-1 matrices over the values that two sets have."""
    lengths = np.array([len(v) for v in (*x, *y)])
    values, column, count = np.unique(np.concatenate((*x, *y)), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(lengths)), lengths)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(x), len(y)))
    step = max(1, (1 << 22) // max(1, len(lengths)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (low, low + step))
        part = np.zeros((len(lengths), step), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        found += part[: len(x)] @ part[len(x) :].T
    return found


def _forest(x: list[tuple], y: list[tuple], similarity: float) -> pa.RecordBatch:
    """Of nodes (node, root, n, shingles) of two blocks, or of one with itself: similar pairs that join what is not joined yet."""
    both = overlaps([r[3] for r in x], [r[3] for r in y])
    n_x, n_y = (np.array([r[2] for r in z], float) for z in (x, y))
    roots_x, roots_y = (np.array([r[1] for r in z], np.int64) for z in (x, y))
    near = (both >= similarity * (n_x[:, None] + n_y[None] - both) - 1e-9) & (roots_x[:, None] != roots_y[None])
    up: dict[int, int] = {}

    def top(k: int) -> int:
        while k in up:
            k = up[k]
        return k

    a, b = [], []
    for i, j in zip(*(v.tolist() for v in np.nonzero(near)), strict=True):
        p, q = top(int(roots_x[i])), top(int(roots_y[j]))
        if p != q:
            up[max(p, q)] = min(p, q)
            a.append(min(x[i][0], y[j][0]))
            b.append(max(x[i][0], y[j][0]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _compare_groups(similarity: float, most: int):
    """Reads (key, node, root, n, shingles) sorted by key. A key's nodes are compared here, or go out as blocks if they are too many."""
    lists = pa.list_(pa.int64())
    kinds = {"a": pa.int64(), "b": pa.int64(), "key": pa.int64(), "block": pa.int32(), "nodes": lists, "roots": lists, "ns": lists, "sets": pa.list_(lists)}

    def batch_of(pairs: pa.RecordBatch | None, block: tuple | None) -> pa.RecordBatch:
        given = dict(zip(list(kinds)[2:], block, strict=True)) if block else dict(zip("ab", pairs.columns, strict=True))
        n = 1 if block else pairs.num_rows
        return pa.RecordBatch.from_arrays([given[c] if c in given and not block else pa.array([given[c]], t) if c in given else pa.nulls(n, t) for c, t in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current, weight, blocks = None, 0, 0

        def done(whole: bool) -> pa.RecordBatch:
            if whole:
                return batch_of(_forest(held, held, similarity), None)
            nodes, roots, ns, sets = zip(*held, strict=True)
            return batch_of(None, (current, blocks, nodes, roots, ns, sets))

        for batch in batches:
            sets = batch.column(4)
            for k, (key, *r) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True)):
                if key != current:
                    if held:
                        yield done(not blocks)
                    held, current, weight, blocks = [], key, 0, 0
                elif len(held) == most or weight > BLOCK_SHINGLES:
                    yield done(False)
                    held, weight, blocks = [], 0, blocks + 1
                held.append((*r, sets[k].values.to_numpy()))
                weight += len(held[-1][3])
        if held:
            yield done(not blocks)

    return run


def _compare_blocks(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = (
                    [(*r, np.array(s, np.int64)) for *r, s in zip(*(batch.column(f"{side}{c}")[i].as_py() for c in ("nodes", "roots", "ns", "sets")), strict=True)]
                    for side in ("x_", "y_")
                )
                yield _forest(x, y, similarity)

    return run


def _similar_in_blocks(apart: DataFrame, sets: DataFrame, similarity: float, most: int) -> DataFrame:
    """(a, b) that join all similar nodes under each key of apart(key, node, root, n); no pair becomes a row before it is compared."""
    names = ("nodes", "roots", "ns", "sets")
    met = apart.select("node", "key", "root", "n").join(sets, "node").select("key", "node", "root", "n", "shingles").repartition("key").sortWithinPartitions("key")
    schema = "a long, b long, key long, block int, nodes array<long>, roots array<long>, ns array<long>, sets array<array<long>>"
    found = cut(met.mapInArrow(_compare_groups(similarity, most), schema))
    links, blocks = found.where("a is not null").select("a", "b"), found.where("a is null").select("key", "block", *names)
    if blocks.isEmpty():
        return links
    side = lambda s: blocks.select("key", F.col("block").alias(f"{s}block"), *[F.col(c).alias(f"{s}{c}") for c in names])
    pairs = side("x_").join(side("y_"), "key").where("x_block <= y_block").repartition(F.xxhash64("key", "x_block", "y_block"))
    return links.union(pairs.select(*[f"{s}{c}" for s in ("x_", "y_") for c in names]).mapInArrow(_compare_blocks(similarity), "a long, b long"))


def keep_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 5, similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """docs without near-duplicates: of each component one row stays, that of the smallest id; rows with a null id come last."""
    rows = keyed(docs)
    marks = sketches(rows, id_col, text_col, size)
    first = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row", "n", "keys", "fp")).alias("h")
    heads = cut(marks.groupBy("whole").agg(first).select("h.id", F.col("h.row").alias("node"), "h.n", "h.keys", "h.fp"))
    sets_of = lambda nodes: shingle_sets(rows.join(nodes.select(F.col("node").alias(ROW)), ROW, "left_semi"), text_col, size)
    roots = components(similar_links(heads.select("node", "n", "keys", "fp"), sets_of, similarity, block))
    placed = heads.select("id", "node").join(roots, "node", "left")
    return first_rows(rows, placed.select(F.col("node").alias("row"), "id", F.coalesce("root", "node").alias("part")), docs.columns)
