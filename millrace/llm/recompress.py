"""Exact substring dedup by recompression.

Words are symbols. A first Spark round names every word and every maximal run of a word, of any length; each further
round draws a side for every name and names the pairs of a left and a right symbol, so symbols grow and texts shrink;
a last round names every two neighbours. Names are numbers of a dictionary that the round itself makes: each bucket of
keys gathers the distinct keys of all blocks, numbers those that the corpus holds twice or more, and sends the numbers
back. So equal names stand for equal words, on every executor, without any hash that could collide. A key that is met
once gets no name: no repeat can hold it.

Every symbol knows the words [low, high) that determine it: its own and those neighbours that decided over a run's end
or against a pair. A window of words that holds them holds the symbol, wherever else the window stands; so a window
that holds a symbol met once has no copy. What is left are candidates. Each goes by the highest symbols that it holds,
the one of least hash among them, to a bucket, together with its words. There the words themselves are compared and the first
start of each window is kept. This settles every word.

Documents are packed into blocks once, and blocks and names lie bucketed by block, so rounds read them without a
shuffle. Blocks send sorted lists of distinct keys: a key, and a passage of one form, counts once per block, so a
passage in a third of all documents is one entry a block, and no bucket, task or driver gathers documents.

Defined results. Null text has no words. Documents with fewer words than a window lose none. "Earlier" goes by
(id, start): rows that repeat an id are one document to this order and keep the same words; null ids come last.
An empty table gives an empty result; other columns of the input are ignored. A long text is a block of its own, whose
task needs some 100 bytes for each of its bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shelved, small_batches
from .vector import SPACE, mix, word_hashes, word_spans

#: Rounds that name pairs.
ROUNDS = 4
BLOCK_BYTES = 2 << 20
#: Bytes of text of which a bucket gathers the keys, about, so that a bucket has half a million of them at most.
BUCKET_BYTES = 10 << 20
#: Bytes of text that a task of a round reads, about, and the largest number of tasks.
TASK_BYTES, MOST_TASKS = 1 << 24, 100_000
NULL_ID = np.iinfo(np.int64).max

_U = np.uint64
_TIMES = _U(0x9E3779B97F4A7C15)


class Layer(NamedTuple):
    """The symbols of a block after a round, in order: names (0: met once), document, first word, words that determine it."""

    name: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Tokens:
    """Named words and runs of the documents of a block. first: word number at which each document begins, and the end."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, words: np.ndarray, runs: np.ndarray) -> None:
        self.ids, self.first, self.words, self.runs = ids, first, words, runs
        self.doc = np.repeat(np.arange(len(ids)), np.diff(first))

    @classmethod
    def of(cls, row: dict) -> Tokens:
        """Of a block that knows the names of its words and runs."""
        names = _answer(row["back_0"])
        return cls(from_planes(row["ids"]), from_planes(row["first"]), names[from_planes(row["words"])], names[from_planes(row["runs"])])

    def base(self) -> Layer:
        """Maximal runs as symbols: their end is seen by the word before and the word behind."""
        at = run_starts(self.words, self.doc, self.first)
        end = np.append(at[1:], len(self.words)).astype(np.int64)
        return Layer(self.runs, self.doc[at], at, at - 1, end + 1)

    def layers(self, returned: list[np.ndarray]) -> tuple[list[Layer], np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The layers that the rounds so far have named, each of the symbols it made; then the places of the next round's
        keys in the last full layer, and the keys."""
        full = self.base()
        found = [full]
        for level in range(1, ROUNDS + 1):
            right = right_side(full.name, level)
            places = pair_places(full, right)
            keys = full.name[places], full.name[places + 1]
            if len(returned) < level:
                return found, places, keys
            full, made = joined(full, places, named(keys, returned[level - 1]), self.first, right)
            found.append(made)
        places = np.flatnonzero((full.doc[1:] == full.doc[:-1]) & (full.name[1:] > 0) & (full.name[:-1] > 0))
        keys = full.name[places], full.name[places + 1]
        if len(returned) > ROUNDS:
            found.append(Layer(named(keys, returned[ROUNDS]), full.doc[places], full.at[places], full.low[places], full.high[places + 1]))
        return found, places, keys


def numbered(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts end to end: where documents begin, in words; the distinct words and runs of two or more (word, blank, length), a
    hash and the number of each; by their numbers the words and the runs."""
    edges = np.concatenate(([0], np.cumsum(lengths)))
    inside = np.concatenate((~SPACE[np.frombuffer(text, np.uint8)], [False]))
    starts, ends = word_spans(inside)
    # A word goes no further than its document.
    cut = np.unique(edges[1:-1])
    cut = cut[inside[cut - 1] & inside[cut]] if len(cut) else cut
    if len(cut):
        starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    first = np.searchsorted(starts, edges)
    data = np.frombuffer(text, np.uint8)
    hashes = word_hashes(data, starts, ends)
    number, head = first_met(hashes)
    if not same_words(data, starts, ends, head[number]):  # two words of one hash
        every: dict[bytes, int] = {}
        number = np.array([every.setdefault(text[a:b], len(every)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        head = np.unique(number, return_index=True)[1]
    keys = [text[a:b] for a, b in zip(starts[head].tolist(), ends[head].tolist(), strict=True)]
    counts = np.bincount(number, minlength=len(keys))
    begin = run_starts(number + 1, np.repeat(np.arange(len(lengths)), np.diff(first)), first)
    length, runs = np.diff(np.append(begin, len(number))), number[begin]
    many = np.flatnonzero(length > 1)
    kinds, which, met = np.unique(np.stack((runs[many], length[many])), axis=1, return_inverse=True, return_counts=True)
    runs[many] = len(keys) + which.ravel()
    keys += [b"%b %d" % (keys[i], n) for i, n in kinds.T.tolist()]
    own = mix(hashes[head[kinds[0]]] + kinds[1].astype(np.uint64)) if len(many) else hashes[:0]
    return first, keys, np.concatenate((hashes[head], own)), np.concatenate((counts, met if len(many) else counts[:0])), number, runs


def first_met(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value among the distinct ones, in order of their first places, and these places; by a table, not by a sort."""
    number = pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)
    head = np.empty(int(number.max(initial=-1)) + 1, np.int64)
    head[number[::-1]] = np.arange(len(number))[::-1]
    return number, head


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each word, data[start:end], has the bytes of its other one, eight after eight."""
    size = ends - starts
    if (size != size[other]).any():
        return False
    lanes = np.ndarray(len(data), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    at = np.flatnonzero(other != np.arange(len(other)))
    x, y, left = starts[at], starts[other[at]], size[at]
    while len(x):
        # What two lanes differ in, without the bytes behind the words.
        if ((lanes[x] ^ lanes[y]) << (_U(64) - _U(8) * np.minimum(left, 8).astype(np.uint64))).any():
            return False
        more = left > 8
        x, y, left = x[more] + 8, y[more] + 8, left[more] - 8
    return True


def run_starts(words: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word numbers at which a maximal run begins; a word met once (0) is a run of its own."""
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1]) | (words[1:] == 0)
    return np.flatnonzero(new)


def right_side(names: np.ndarray, level: int) -> np.ndarray:
    return (mix(names.astype(np.uint64) * _U(16) + _U(level)) >> _U(63)).astype(bool)


def pair_places(layer: Layer, right: np.ndarray) -> np.ndarray:
    """Numbers of the symbols that join the next one: left before right, both named, of one document."""
    known = layer.name > 0
    return np.flatnonzero((layer.doc[1:] == layer.doc[:-1]) & known[1:] & known[:-1] & ~right[:-1] & right[1:])


def joined(layer: Layer, places: np.ndarray, names: np.ndarray, first: np.ndarray, right: np.ndarray) -> tuple[Layer, Layer]:
    """The layer with pairs joined, and the pairs alone. A symbol that stays single depends on the neighbour on its open side."""
    n = len(layer.name)
    new = np.flatnonzero(layer.doc[1:] != layer.doc[:-1]) + 1  # the first symbols of documents, but for the first one
    before, behind = np.empty(n, np.int64), np.empty(n, np.int64)
    before[1:], behind[:-1] = layer.low[:-1], layer.high[1:]
    begin, end = np.append(np.zeros(min(n, 1), np.int64), new), np.append(new - 1, np.full(min(n, 1), n - 1))
    before[begin], behind[end] = first[layer.doc[begin]] - 1, first[layer.doc[end] + 1] + 1
    low, high = np.where(right, np.minimum(before, layer.low), layer.low), np.where(right, layer.high, np.maximum(behind, layer.high))
    name, keep = layer.name.copy(), np.ones(n, bool)
    name[places], low[places], high[places] = names, layer.low[places], layer.high[places + 1]
    keep[places + 1] = False
    made = Layer(names, layer.doc[places], layer.at[places], low[places], high[places])
    return Layer(name[keep], layer.doc[keep], layer.at[keep], low[keep], high[keep]), made


def distinct(keys: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order of a hash, that hash, whether met twice, and the number of each key given."""
    a, b = keys
    h = mix(a.astype(np.uint64) * _TIMES + mix(b.astype(np.uint64)))
    order = np.argsort(h, kind="stable")
    x, y, z = a[order], b[order], h[order]
    new, other = np.ones(len(x), bool), (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    new[1:] = z[1:] != z[:-1]
    if (other & ~new[1:]).any():  # two keys of one hash: sort by the keys as well
        order = np.lexsort((b, a, h))
        x, y, z = a[order], b[order], h[order]
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    head = np.flatnonzero(new)
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    return np.stack((x[head], y[head])), z[head], np.diff(np.append(head, len(x))) > 1, number


def named(keys: tuple[np.ndarray, np.ndarray], names: np.ndarray) -> np.ndarray:
    """The name of each key; names: of the distinct keys in order."""
    return names[distinct(keys)[3]] if len(keys[0]) else np.empty(0, np.int64)


def window_hashes(values: np.ndarray, window: int) -> np.ndarray:
    """A hash of every `window` neighbouring values."""
    power, done = 1, 0
    block, out = mix(values.astype(np.uint64)), None
    while power <= window:
        if window & power:
            part = block[done:]
            out = part if out is None else mix(out[: len(part)] * _TIMES + part)
            done += power
        block = mix(block[: max(0, len(block) - power)] * _TIMES + block[power:])
        power *= 2
    return out[: max(0, len(values) - window + 1)]


def leftmost_least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each range [begin, end) of values, none empty, the number of the first least one."""
    table, out = np.arange(len(values)), np.zeros(len(begin), np.int64)
    width, size = 1, end - begin
    less = lambda i, j: np.where(values[i] <= values[j], i, j)
    while len(size) and width <= size.max():
        now = (size >= width) & (size < 2 * width)
        out[now] = less(table[begin[now]], table[end[now] - width])
        table = less(table[: max(0, len(table) - width)], table[width:])
        width *= 2
    return out


class Entries:
    """Candidate windows of a block: runs of neighbouring starts that share a symbol. Those of equal words count once, by the
    first (id, offset); heads are in order of their bucket."""

    def __init__(self, tokens: Tokens, layers: list[Layer], window: int, buckets: int) -> None:
        self.tokens, self.window = tokens, window
        words, first = tokens.words, tokens.first
        starts = self._candidates(layers)
        route, place = self._symbols(layers, starts)
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) != 1) | (place[1:] != place[:-1]) | (route[1:] != route[:-1]) | (tokens.doc[starts[1:]] != tokens.doc[starts[:-1]])
        at = np.flatnonzero(new)
        self.start, self.count = starts[at], np.diff(np.append(at, len(starts)))
        self._place(tokens.ids, first)
        hashes = window_hashes(words, window) if len(at) else np.empty(0, np.uint64)
        key = mix(hashes[self.start] * _TIMES + mix(hashes[self.start + self.count - 1] + self.count.astype(np.uint64))) if len(at) else hashes
        bucket = (mix(route[at]) % _U(buckets)).astype(np.int64)
        order = np.lexsort((self.offset, self.id, key, bucket))
        lead = np.ones(len(order), bool)
        lead[1:] = (key[order][1:] != key[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        head = order[np.flatnonzero(lead)][np.cumsum(lead) - 1] if len(order) else order
        same = self._equal(order, head)
        lead |= ~same
        self.heads = order[lead]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(lead) - 1
        self.head = np.empty(len(order), np.int64)  # of every entry the place among the heads of the one that it equals
        self.head[order] = place[np.where(lead, order, head)]
        self.bucket = bucket[self.heads]

    @classmethod
    def of(cls, row: dict, window: int, tokens: Tokens | None = None) -> Entries:
        """Of a block that knows what packed() kept; messages() needs the tokens."""
        found = cls.__new__(cls)
        found.tokens, found.window = tokens, window
        found.start = np.cumsum(from_planes(row["starts"]))
        found.count, found.heads, found.head, found.bucket = (from_planes(row[k]) for k in ("counts", "heads", "head", "buckets"))
        found._place(from_planes(row["ids"]), from_planes(row["first"]))
        return found

    def packed(self) -> dict:
        return {"starts": planes(np.diff(self.start, prepend=0)), "counts": planes(self.count), "heads": planes(self.heads), "head": planes(self.head), "buckets": planes(self.bucket)}

    def _place(self, ids: np.ndarray, first: np.ndarray) -> None:
        doc = np.searchsorted(first, self.start, "right") - 1
        self.id, self.offset, self.first = ids[doc], self.start - first[doc], first

    def _candidates(self, layers: list[Layer]) -> np.ndarray:
        tokens, window = self.tokens, self.window
        n = len(tokens.words)
        if n < window:
            return np.empty(0, np.int64)
        low, high = [np.flatnonzero(tokens.words == 0)], []
        high.append(low[0] + 1)
        for x in layers:
            once = (x.name == 0) & (x.high - x.low <= window)
            low.append(x.low[once]), high.append(x.high[once])
        low, high = np.concatenate(low), np.concatenate(high)
        edge = np.bincount(np.clip(high - window, 0, n), minlength=n + 1) - np.bincount(np.clip(low + 1, 0, n), minlength=n + 1)
        free = np.cumsum(edge)[: n - window + 1] <= 0
        return np.flatnonzero(free & (tokens.doc[: n - window + 1] == tokens.doc[window - 1 :]))

    def _symbols(self, layers: list[Layer], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start the hash and first word of the symbol that its window goes by: of the highest layer with a symbol inside,
        the one of least hash; a window without any goes by its first word."""
        route, place = mix(self.tokens.words[starts].astype(np.uint64)), starts.copy()
        left = np.arange(len(starts))
        for x in reversed(layers):
            if not len(x.name) or not len(left):
                continue
            s = starts[left]
            begin, end = np.searchsorted(x.low, s), np.searchsorted(x.high, s + self.window, "right")
            held = np.flatnonzero(begin < end)
            value = mix(x.name.astype(np.uint64) * _U(3))
            pick = leftmost_least(value, begin[held], end[held])
            route[left[held]], place[left[held]] = value[pick], x.at[pick]
            left = np.delete(left, held)
        return route, place

    def _equal(self, order: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Whether the entries in order have the words of their heads."""
        same = self.count[order] == self.count[head]
        size = np.where(same, self.count[order] + self.window - 1, 0)
        words = self.tokens.words
        differ = words[spread(self.start[order], size)] != words[spread(self.start[head], size)]
        same[np.repeat(np.arange(len(order)), size)[differ]] = False
        return same

    def messages(self) -> Iterator[dict]:
        """One a bucket: words, sizes and places of the heads."""
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(self.heads)], strict=False):
            e = self.heads[a:b]
            size = self.count[e] + self.window - 1
            yield {
                "bucket": int(self.bucket[a]),
                "words": planes(self.tokens.words[spread(self.start[e], size)]),
                "counts": planes(self.count[e]),
                "ids": planes(self.id[e]),
                "offsets": planes(self.offset[e]),
            }

    def removed(self, flags: np.ndarray) -> np.ndarray:
        """Which words go. flags: of every window of the heads, in order, whether it starts earlier elsewhere."""
        edge = np.zeros(self.first[-1] + 1, np.int64)
        if len(self.start):
            h = self.heads[self.head]
            own = (self.id == self.id[h]) & (self.offset == self.offset[h])
            base = np.concatenate(([0], np.cumsum(self.count[self.heads])))[self.head]
            starts = spread(self.start, self.count)
            hit = starts[~np.repeat(own, self.count) | flags[spread(base, self.count)]]
            edge += np.bincount(hit, minlength=len(edge)) - np.bincount(hit + self.window, minlength=len(edge))
        return np.cumsum(edge[:-1]) > 0


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then the same of the next."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def later_windows(words: np.ndarray, counts: np.ndarray, ids: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Whether each window of some entries starts earlier in one of them. Entries of `count` windows lie end to end in words."""
    size = counts + window - 1
    at = spread(np.cumsum(size) - size, counts)
    step = spread(np.zeros_like(counts), counts)
    ids, offsets = np.repeat(ids, counts), np.repeat(offsets, counts) + step
    h = window_hashes(words, window)[at]
    order = np.lexsort((offsets, ids, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    strange: set[int] = set()  # hashes that stand for different words
    for a in range(0, len(order), 1 << 16):
        x, y = order[a : a + (1 << 16)], head[a : a + (1 << 16)]
        differ = np.zeros(len(x), bool)
        for k in range(window):
            differ |= words[at[x] + k] != words[at[y] + k]
        strange.update(h[x[differ]].tolist())
    later = np.empty(len(order), bool)
    later[order] = (ids[order] != ids[head]) | (offsets[order] != offsets[head])
    if strange:
        firsts: dict[bytes, tuple[int, int]] = {}
        for i in order[np.isin(h[order], np.array(sorted(strange), np.uint64))].tolist():
            place = (int(ids[i]), int(offsets[i]))
            later[i] = firsts.setdefault(words[at[i] : at[i] + window].tobytes(), place) != place
    return later


def planes(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, byte plane by byte plane without empty ones, compressed."""
    values = np.ascontiguousarray(values, np.int64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8) if values.min(initial=0) >= 0 else 8
    return bytes([width]) + zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def from_planes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, : data[0]] = raw.T
    return out.view(np.int64).ravel()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Consecutive rows with the same key."""
    held: list[dict] = []
    for row in _rows(batches):
        if held and held[-1][key] != row[key]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += 64 + sum(len(x) for x in row.values() if isinstance(x, (bytes, str)))
        if n > size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _schema(**kinds) -> tuple[pa.Schema, str]:
    """An Arrow schema and its SQL form, of columns int, str, bytes or a list of str."""
    arrow = {"int": pa.int64(), "str": pa.string(), "bytes": pa.binary(), "list": pa.list_(pa.string())}
    sql = {"int": "long", "str": "string", "bytes": "binary", "list": "array<string>"}
    return pa.schema([(k, arrow[v]) for k, v in kinds.items()]), ", ".join(f"{k} {sql[v]}" for k, v in kinds.items())


class Dedup:
    """The rounds over one table: each method is a Spark stage or an exchange between blocks and buckets."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, window: int, rest: Column | None) -> None:
        self.window, self.carried = window, rest is not None
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        self.slim = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), (F.lit(None).cast("string") if rest is None else rest).alias("rest"))
        total = self.slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.tasks = min(MOST_TASKS, max(8, total // TASK_BYTES))
        self.buckets = max(16, total // BUCKET_BYTES)

    def blocks(self) -> DataFrame:
        """Whole documents packed by block: ids, lengths and text; the distinct words and runs of words (keys, twice: met twice
        there) in order of a hash, and where buckets cut them; by their numbers the words and runs of the text, and where documents begin."""
        schema, sql = _schema(block="int", ids="bytes", lengths="bytes", text="bytes", rest="list", first="bytes", words="bytes", runs="bytes", keys="bytes", cuts="bytes", twice="bytes")
        buckets, carried = self.buckets, self.carried

        def pack(ids, texts, others):
            order = sorted(range(len(ids)), key=ids.__getitem__)
            texts = [texts[i] for i in order]
            text = b"".join(texts)
            first, keys, hashes, counts, of, runs = numbered(text, np.array(list(map(len, texts)), np.int64))
            by_hash = np.argsort(hashes, kind="stable")
            place = np.empty(len(keys), np.int64)
            place[by_hash] = np.arange(len(keys))
            return {
                "block": uuid.uuid4().int >> 65,
                "ids": planes(np.array([ids[i] for i in order], np.int64)),
                "lengths": planes(np.array(list(map(len, texts)), np.int64)),
                "text": zstandard.ZstdCompressor(3).compress(text),
                "rest": [others[i] for i in order] if carried else None,
                "first": planes(first),
                "words": planes(place[of]),
                "runs": planes(place[runs]),
                "keys": zstandard.ZstdCompressor(1).compress(b"\n".join(keys[i] for i in by_hash.tolist())),
                "cuts": planes(_cuts(hashes[by_hash], buckets)),
                "twice": planes(counts[by_hash] > 1),
            }

        def run(batches):
            ids, texts, others, size = [], [], [], 0
            for batch in batches:
                for i, x, other in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    data = x.encode()
                    if size + len(data) > BLOCK_BYTES and ids:
                        yield pack(ids, texts, others)
                        ids, texts, others, size = [], [], [], 0
                    ids.append(int(NULL_ID) if i is None else i), texts.append(data), others.append(other)
                    size += len(data)
            if ids:
                yield pack(ids, texts, others)

        return shelved(self.slim.mapInArrow(lambda b: _batched(run(b), schema), sql), "block", self.tasks)

    def exchange(self, source: DataFrame, send, judge, **kinds) -> DataFrame:
        """(block, back array<struct<bucket, names>>): what judge makes of the messages that send makes of the blocks of source.

        send: row -> messages with bucket; judge: the messages of one bucket -> an answer for each.
        """
        sent, sent_sql = _schema(bucket="int", block="int", **kinds)
        kept, kept_sql = _schema(block="int", bucket="int", names="bytes")

        def out(batches):
            return _batched(({"block": row["block"], **m} for row in _rows(batches) for m in send(row)), sent)

        def answers(group):
            return ({"block": x["block"], "bucket": x["bucket"], "names": y} for x, y in zip(group, judge(group), strict=True))

        def back(batches):
            return _batched((x for group in _groups(batches, "bucket") for x in answers(group)), kept)

        met = source.mapInArrow(out, sent_sql).repartition(min(MOST_TASKS, self.buckets), "bucket").sortWithinPartitions("bucket")
        answered = met.mapInArrow(back, kept_sql).repartition(self.tasks, "block")
        return shelved(answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "names")).alias("back")), "block", self.tasks)

    def words(self, blocks: DataFrame) -> DataFrame:
        """Names the words and the runs of words of all blocks."""
        buckets = self.buckets

        def send(row):
            keys, twice = zstandard.ZstdDecompressor().decompress(row["keys"]).split(b"\n"), from_planes(row["twice"])
            at = from_planes(row["cuts"]).tolist()
            for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                if a == b:
                    continue
                yield {"bucket": k, "keys": zstandard.ZstdCompressor(1).compress(b"\n".join(keys[a:b])), "twice": planes(twice[a:b])}

        def judge(group):
            lists = [zstandard.ZstdDecompressor().decompress(x["keys"]).split(b"\n") for x in group]
            met: dict[bytes, int] = {}
            for row, mine in zip(group, lists, strict=True):
                for key, twice in zip(mine, from_planes(row["twice"]).tolist(), strict=True):
                    met[key] = met.get(key, 0) + 1 + twice
            serial = {key: i for i, key in enumerate((k for k, n in met.items() if n > 1), 1)}
            return (planes(_names(np.array([serial.get(k, 0) for k in mine], np.int64), group[0]["bucket"], buckets, 0)) for mine in lists)

        return self.exchange(blocks.select("block", "keys", "cuts", "twice"), send, judge, keys="bytes", twice="bytes")

    def pairs(self, state: DataFrame, level: int) -> DataFrame:
        """Names the pairs of one round, or, in the last, all neighbours."""
        buckets = self.buckets

        def send(row):
            tokens, returned = _state(row, level - 1)
            _, _, keys = tokens.layers(returned)
            (a, b), h, twice, _ = distinct(keys)
            # The hash falls into even ranges, one a bucket.
            for k, i, j in _ranges(h, buckets):
                yield {"bucket": k, "left": planes(a[i:j]), "right": planes(b[i:j]), "twice": planes(twice[i:j])}

        def judge(group):
            lists = [(from_planes(x["left"]), from_planes(x["right"])) for x in group]
            sizes = [len(a) for a, _ in lists]
            a, b = (np.concatenate(x) for x in zip(*lists, strict=True))
            _, _, often, number = distinct((a, b))
            often = often.copy()
            often[number[np.concatenate([from_planes(x["twice"]) for x in group]) > 0]] = True
            serial = np.where(often, np.cumsum(often), 0)[number]
            return (planes(_names(x, group[0]["bucket"], buckets, level)) for x in np.split(serial, np.cumsum(sizes)[:-1]))

        return self.exchange(state, send, judge, left="bytes", right="bytes", twice="bytes")

    def entries(self, state: DataFrame) -> DataFrame:
        """The candidate windows of every block, found once for settle() and cleaned()."""
        schema, sql = _schema(block="int", starts="bytes", counts="bytes", heads="bytes", head="bytes", buckets="bytes")
        buckets, window = self.buckets, self.window

        def run(batches):
            return _batched(({"block": row["block"], **_entries(row, window, buckets).packed()} for row in _rows(batches)), schema)

        return shelved(state.mapInArrow(run, sql), "block", self.tasks)

    def settle(self, state: DataFrame, entries: DataFrame) -> DataFrame:
        """Of every candidate window whether it starts earlier in another block."""
        window = self.window

        def send(row):
            yield from Entries.of(row, window, Tokens.of(row)).messages()

        def judge(group):
            lists = [[from_planes(x[k]) for x in group] for k in ("words", "counts", "ids", "offsets")]
            later = later_windows(*map(np.concatenate, lists), window)
            return (np.packbits(x).tobytes() for x in np.split(later, np.cumsum([x.sum() for x in lists[1]])[:-1]))

        source = state.select("block", "ids", "first", "words", "runs", "back_0").join(entries.hint("shuffle_hash"), "block")
        return self.exchange(source, send, judge, words="bytes", counts="bytes", ids="bytes", offsets="bytes")

    def cleaned(self, blocks: DataFrame, found: DataFrame, settled: DataFrame, with_text: bool) -> DataFrame:
        schema, sql = _schema(id="int", n_words="int", n_removed="int", kept_sha256="str", **{"text": "str"} if with_text else {}, **{"rest": "str"} if self.carried else {})
        window, carried = self.window, self.carried

        def run(batches):
            for row in _rows(batches):
                entries, ids = Entries.of(row, window), from_planes(row["ids"])
                sizes = [int(entries.count[entries.heads[entries.bucket == k]].sum()) for k in np.unique(entries.bucket)]
                bits = [x["names"] for x in sorted(row["settled"] or (), key=lambda x: x["bucket"])]
                flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(bits, sizes, strict=True)]
                gone = entries.removed(np.concatenate([np.empty(0, np.uint8), *flags]).astype(bool))
                first = entries.first
                for i, text in enumerate(_texts(row)):
                    own, words = gone[first[i] : first[i + 1]], text.split()
                    lost = int(own.sum())
                    body = b" ".join(compress(words, (~own).tolist()) if lost else words)
                    number = int(ids[i])
                    found = {"id": None if number == NULL_ID else number, "n_words": len(words), "n_removed": lost, "kept_sha256": hashlib.sha256(body).hexdigest()}
                    if with_text:  # where the row's own columns stay, a text that loses nothing keeps its white space
                        found["text"] = (body if lost or not carried else text).decode()
                    if carried:
                        found["rest"] = row["rest"][i]
                    yield found

        every = blocks.select("block", "ids", "first", "lengths", "text", "rest").join(found.hint("shuffle_hash"), "block").join(settled.withColumnRenamed("back", "settled").hint("shuffle_hash"), "block", "left")
        return every.mapInArrow(lambda b: _batched(run(b), schema), sql)


def _texts(row: dict) -> list[bytes]:
    data, ends = zstandard.ZstdDecompressor().decompress(row["text"]), np.cumsum(from_planes(row["lengths"])).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _names(serial: np.ndarray, bucket: int, buckets: int, level: int) -> np.ndarray:
    """Names of serial numbers from 1 within a bucket and round; 0 stays 0."""
    return np.where(serial > 0, (serial * buckets + bucket) * 8 + level, 0)


def _cuts(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among ascending hashes, and the end."""
    edges = [k * (1 << 64) // buckets for k in range(1, buckets)]
    return np.concatenate(([0], np.searchsorted(h, np.array(edges, np.uint64)), [len(h)]))


def _ranges(h: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ascending hashes."""
    at = _cuts(h, buckets).tolist()
    return ((k, a, b) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b)


def _answer(back: list | None) -> np.ndarray:
    """Names in the order in which their keys went out."""
    return np.concatenate([np.empty(0, np.int64), *[from_planes(x["names"]) for x in sorted(back or (), key=lambda x: x["bucket"])]])


def _state(row: dict, levels: int) -> tuple[Tokens, list[np.ndarray]]:
    return Tokens.of(row), [_answer(row[f"back_{k}"]) for k in range(1, levels + 1)]


def _entries(row: dict, window: int, buckets: int) -> Entries:
    tokens, returned = _state(row, ROUNDS + 1)
    return Entries(tokens, tokens.layers(returned)[0], window, buckets)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 20, with_text: bool = False, rest: Column | None = None) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, text][, rest]) of every row.

    Every word goes that a window of `window` words covers whose word sequence also starts earlier in the input.
    kept_sha256: hex SHA-256 of the kept words, joined by one space. with_text: that text itself as well.
    rest: a string of each row that stays beside its result, whatever the ids.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    small_batches(docs.sparkSession)
    job = Dedup(docs, id_col, text_col, window, rest)
    blocks = job.blocks()
    state = blocks.select("block", "ids", "first", "words", "runs")
    for level in range(ROUNDS + 2):
        back = job.pairs(state, level) if level else job.words(blocks)
        state = state.join(back.withColumnRenamed("back", f"back_{level}").hint("shuffle_hash"), "block", "left")
    entries = job.entries(state)
    return job.cleaned(blocks, entries, job.settle(state, entries), with_text).withColumnRenamed("id", id_col)
