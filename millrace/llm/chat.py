"""Chat formatting at token level.

Every role and every text is encoded by itself, so no merge crosses a boundary; reserved ids are spliced
between them. Control strings inside a role or text are escaped first, so a text can never close its turn.
The loss mask comes from prefix sums over segment lengths. Turns are formatted one by one in any partition;
only the assembled pieces of a conversation meet, sorted by turn, and stream through.

Defined results. Null role or text counts as empty. Rows go by turn, null turns first, ties by role and text;
repeated rows are repeated turns. Rows with a null conversation id form one conversation of their own. A text of any
length is encoded whole, so its ids are those of its own encoding. An empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Where the driver's machine keeps the public vocabulary file; executors get its bytes, less than 1 MB, in a broadcast.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's byte-level BPE splits a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Control strings, in the order of their reserved ids after the vocabulary.
START, MIDDLE, END = CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
#: White space so long that the pattern's look-ahead would exhaust its matcher; the pattern takes all of it but the last sign as one
#: piece, or all of it at the end of the text.
GAP = regex.compile(r"\p{White_Space}{1000,}")
LEARNED_ROLE = "assistant"

_encodings: dict[str, Encoder] = {}


class Encoder:
    """A vocabulary's encoding of texts, and of texts that are one piece already."""

    def __init__(self, data: bytes) -> None:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
        self.pieces, self.piece = (tiktoken.Encoding("chat", pat_str=x, mergeable_ranks=ranks, special_tokens={}) for x in (PATTERN, r"[\s\S]+"))
        self.n_vocab = self.pieces.n_vocab

    def encode(self, text: str) -> list[int]:
        ids, at = [], 0
        for m in GAP.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            ids += self.pieces.encode_ordinary(text[at : m.start()]) + self.piece.encode_ordinary(text[m.start() : end])
            at = end
        return ids + self.pieces.encode_ordinary(text[at:])

    def decode_bytes(self, ids: list[int]) -> bytes:
        return self.pieces.decode_bytes(ids)


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(data: bytes) -> Encoder:
    """The encoder of a vocabulary file's bytes, made once a process."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _encodings:
        _encodings[key] = Encoder(data)
    return _encodings[key]


def escape(text: str) -> str:
    """A text without any "<|": one backslash more between the two signs, whatever number stands there."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turn(enc: Encoder, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of one turn and its loss mask: over the text of an assistant's turn, never over control ids."""
    first = enc.n_vocab
    segments = [[first], enc.encode(escape(role)), [first + 1], enc.encode(escape(text)), [first + 2]]
    ends = np.cumsum([len(x) for x in segments])
    ids = np.fromiter((i for x in segments for i in x), np.int32, int(ends[-1]))
    edge = np.zeros(len(ids) + 1, np.int8)
    if role == LEARNED_ROLE:
        edge[ends[2]] += 1
        edge[ends[3]] -= 1
    return ids, np.cumsum(edge[:-1]).astype(bool)


def decode(enc: Encoder, ids: np.ndarray) -> str:
    """The formatted string of token ids, control strings included."""
    first, out, at = enc.n_vocab, [], 0
    for i in [*np.flatnonzero(ids >= first), len(ids)]:
        out.append(enc.decode_bytes(ids[at:i].tolist()).decode())
        if i < len(ids):
            out.append(CONTROL[ids[i] - first])
        at = i + 1
    return "".join(out)


def read_turns(enc: Encoder, ids: np.ndarray) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in token ids."""
    first = enc.n_vocab
    starts, middles, ends = (np.flatnonzero(ids == first + k) for k in range(3))
    if not len(starts) == len(middles) == len(ends):
        raise ValueError("turns are not balanced")
    for a, b, c in zip(starts, middles, ends, strict=True):
        if not a < b < c:
            raise ValueError("control ids are out of order")
        role, text = (unescape(enc.decode_bytes(ids[x + 1 : y].tolist()).decode()) for x, y in ((a, b), (b, c)))
        yield role, text


def format_turns(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of conversations(conv_id, turn, role, text): ids array<int> and mask array<boolean> of its turn.

    A conversation's tokens are those of its turns in order (conv_id, turn, role, text), end to end.
    """
    small_batches(conversations.sparkSession)
    shared = conversations.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value)
        for batch in batches:
            made = [format_turn(enc, r, x) for r, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [*batch.columns, pa.array([x for x, _ in made], pa.list_(pa.int32())), pa.array([m for _, m in made], pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "mask"])

    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, ids array<int>, mask array<boolean>")


def digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per conversation of format_turns() rows, read back from ids and masks alone:

    n_turns, turns_sha256 over role, \\n, text, \\n of every turn, loss_chars and loss_sha256 of the unescaped text
    under the mask, formatted_chars of the formatted string. A conversation streams through: only hash states stay.
    """
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    schema = pa.schema(kinds)
    shared = formatted.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value)
        now, state = None, None

        def row():
            n, turns, chars, loss, size = state
            return [now[0], n, turns.hexdigest(), chars, loss.hexdigest(), size]

        for batch in batches:
            done = []
            for conv, ids, mask in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if state is None or now[0] != conv:
                    if state is not None:
                        done.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = ids.values.to_numpy(zero_copy_only=False)
                mask = mask.values.to_numpy(zero_copy_only=False)
                for role, text in read_turns(enc, ids):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                learned = unescape(decode(enc, ids[mask]))
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(decode(enc, ids))
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(kinds, x, strict=True)) for x in done], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(kinds, row(), strict=True))], schema=schema)

    # The role and text decide ties only; the digests read ids and masks.
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "ids", "mask")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
