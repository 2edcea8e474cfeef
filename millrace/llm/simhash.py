"""SimHash near-duplicates by multi-index hashing.

Every text gets a 64-bit fingerprint of its word shingles. Fingerprints link when they differ in few bits.
Two segments of 32 bits index the distinct fingerprints: of two fingerprints at most four bits apart, one
segment differs in at most two bits, so the Hamming balls of radius one around both segments share a key.
Every fingerprint enters the table under the 33 keys of each ball, equal keys meet in one place, and the
complete distance of what meets there is verified. A bucket yields a spanning forest of its verified links,
never its pairs; buckets beyond a bound go on as blocks that are compared block by block in other tasks.

Defined results. Null text counts as empty; a text without words has fingerprint zero and links like any
other. Repeated rows are kept. A null id never becomes a component's id unless the component has no other. An empty
table gives an empty result; other columns are ignored, whatever their names. A text's fingerprint takes memory for
eight bytes a shingle. With two segments of 32 bits a key of the tables holds some N * 33 / 2^32 of N distinct
fingerprints, so buckets are short up to 10^9 of them and grow in proportion from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, cut, first_rows, keyed, small_batches
from .graph import components

SEED = 42
BITS = 64
#: Parts into which the members of a component are dealt when they get its label.
SALTS = 32
#: Members of a bucket compared in the task that read it; larger buckets go on in blocks of this size.
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 20


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 of every shingle of the text with A-Z lowered; the whole sequence if it is shorter, none without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return []
    if len(found) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]


def majority_bits(hashes: list[int] | np.ndarray) -> int:
    """The bits set in over half of the hashes, as an unsigned number."""
    if not len(hashes):
        return 0
    total = np.zeros(BITS, np.int64)
    every = np.array(hashes, ">u8")
    for at in range(0, len(every), 1 << 16):
        part = every[at : at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long. One narrow stage over whole texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority_bits(shingle_hashes(x.as_py(), size)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "id long, fp long")


def ball_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): the 33 keys of the radius-one ball of either 32-bit segment, 66 rows a fingerprint."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    keys = []
    for k, half in enumerate((low, high)):
        base = half.bitwiseOR(F.lit(k << 32))
        keys += [base, *[base.bitwiseXOR(F.lit(1 << i)) for i in range(32)]]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _forest(f: np.ndarray, g: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the connectivity of all links between f and g (both sorted, distinct): at most len(f) + len(g)."""
    label = np.arange(len(f))
    other = np.full(len(g), -1)
    left, right = [], []
    step = max(1, PAIRS_AT_ONCE // max(1, len(g)))
    for at in range(0, len(f), step):
        near = np.bitwise_count(f[at : at + step, None] ^ g[None, :]) <= limit
        for i in np.flatnonzero(near.any(axis=1)):
            cols = np.flatnonzero(near[i])
            roots = {_root(label, at + i)}
            for c in cols:
                if other[c] < 0:
                    other[c] = at + i
                    left.append(f[at + i]), right.append(g[c])
                elif (r := _root(label, other[c])) not in roots:
                    roots.add(r)
                    left.append(f[at + i]), right.append(g[c])
            least = min(roots)
            for r in roots:
                label[r] = least
    return np.array(left, np.uint64), np.array(right, np.uint64)


def _root(label: np.ndarray, i: int) -> int:
    while label[i] != i:
        label[i] = label[label[i]]
        i = label[i]
    return int(i)


def _bucket_links(limit: int):
    """Reads (key, fp) sorted by key; yields edges (a, b), and for buckets beyond BLOCK their blocks (key, block, fps)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("block", pa.int32()), ("fps", pa.binary())])

    def rows(a, b, big=()):
        n, m = len(a), len(big)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*np.asarray(a, np.uint64).view(np.int64).tolist(), *[None] * m], pa.int64()),
                pa.array([*np.asarray(b, np.uint64).view(np.int64).tolist(), *[None] * m], pa.int64()),
                pa.array([*[None] * n, *[x[0] for x in big]], pa.int64()),
                pa.array([*[None] * n, *[x[1] for x in big]], pa.int32()),
                pa.array([*[None] * n, *[x[2] for x in big]], pa.binary()),
            ],
            schema=schema,
        )

    def settle(key, fp):
        """Links inside whole buckets; keys sorted."""
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts, sizes = np.concatenate(([0], cuts)), np.diff(np.concatenate(([0], cuts, [len(key)])))
        two = starts[sizes == 2]
        x, y = fp[two], fp[two + 1]
        near = np.bitwise_count(x ^ y) <= limit
        left, right = [x[near]], [y[near]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            members = np.sort(fp[s : s + n])
            a, b = _forest(members, members, limit)
            left.append(a), right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        return a[a != b], b[a != b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp, blocks = np.empty(0, np.int64), np.empty(0, np.uint64), 0
        for batch in batches:
            key = np.concatenate((held_key, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((held_fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(key):
                continue
            tail = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            if tail and blocks:  # what is left of a large bucket is its last block
                end = int(np.searchsorted(key, key[0], "right"))
                yield rows([], [], [(int(key[0]), blocks, fp[:end].tobytes())])
                key, fp, tail, blocks = key[end:], fp[end:], tail - end, 0
            if tail:
                yield rows(*settle(key[:tail], fp[:tail]))
                key, fp = key[tail:], fp[tail:]
            while len(key) > BLOCK:
                yield rows([], [], [(int(key[0]), blocks, fp[:BLOCK].tobytes())])
                key, fp, blocks = key[BLOCK:], fp[BLOCK:], blocks + 1
            held_key, held_fp = key, fp
        if len(held_key):
            if blocks:
                yield rows([], [], [(int(held_key[0]), blocks, held_fp.tobytes())])
            else:
                yield rows(*settle(held_key, held_fp))

    return run


def _block_links(limit: int):
    """Reads pairs of blocks; yields their edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                f, g = (np.sort(np.frombuffer(v.as_py(), np.uint64)) for v in (x, y))
                a, b = _forest(f, g, limit)
                keep = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[keep].view(np.int64)), pa.array(b[keep].view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, limit: int = 4) -> DataFrame:
    """(a, b): verified links whose components are those of all pairs of distinct fps(fp) at most limit <= 4 bits apart."""
    if limit > 4:
        raise ValueError("balls of radius one in two segments find distances up to 4")
    met = ball_keys(fps).repartition("key").sortWithinPartitions("key")
    found = cut(met.mapInArrow(_bucket_links(limit), "a long, b long, key long, block int, fps binary"))
    edges = found.where("a is not null").select("a", "b")
    blocks = found.where("a is null").select("key", "block", "fps")
    if blocks.isEmpty():
        return edges
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, F.expr("x.key = y.key and x.block <= y.block")).select("x.fps", F.col("y.fps").alias("other"))
    more = pairs.repartition(F.xxhash64("fps", "other")).mapInArrow(_block_links(limit), "a long, b long")
    return edges.union(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 4, limit: int = 4) -> DataFrame:
    """(id, fingerprint, component_id, n_links) for every row.

    fingerprint has 16 hex digits. component_id is the smallest id reachable over links; n_links counts the
    rows of the component. Shuffles ids and fingerprints only, never texts.
    """
    marks = cut(fingerprints(docs, id_col, text_col, size))
    nodes = cut(marks.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    roots = components(fingerprint_links(nodes.select("fp"), limit)).withColumnRenamed("node", "fp")
    linked = cut(nodes.join(roots, "fp"))
    # A label goes out in SALTS copies, so no task reads a large component whole.
    groups = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("n_links")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    labels = linked.select("fp", "root", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int").alias("salt")).join(groups, ["root", "salt"]).drop("root", "salt")
    alone = nodes.join(roots, "fp", "left_anti").select("fp", F.col("least").alias("component_id"), F.col("rows").alias("n_links"))
    return marks.join(labels.union(alone), "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_links",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without near-duplicates: of each component one row stays, that of the smallest id; rows with a null id come last.

    Rows are told apart by a key of their own, never by id.
    """
    rows = keyed(docs)
    found = near_duplicates(rows, ROW, text_col, **how).select(F.col(ROW).alias("row"), F.col("component_id").alias("part"))
    placed = found.join(rows.select(F.col(ROW).alias("row"), F.col(id_col).cast("long").alias("id")), "row")
    return first_rows(rows, placed, docs.columns)
