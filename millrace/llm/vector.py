"""Words of many texts at once: spans and hashes as arrays over one byte buffer."""

from __future__ import annotations

import numpy as np

_U = np.uint64
BASE = _U(0x9E3779B97F4A7C15)
BASE2 = _U(0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random value for each byte, the same in every process.
BYTES = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse modulo 2^64, at least n of each."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        tables = []
        for b in (int(base), pow(int(base), -1, 1 << 64)):
            x = np.full(size, _U(b))
            x[0] = 1
            tables.append(np.cumprod(x, dtype=np.uint64))
        have = _powers[int(base)] = tuple(tables)
    return have


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Polynomial hashes of values[start:end], by prefix sums modulo 2^64."""
    power, inverse = _power_tables(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:], dtype=np.uint64)
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], eight bytes after eight; each step is a bijection of what came before, so words of up to eight
    bytes never collide and longer ones only by chance."""
    lanes = np.ndarray(len(data), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    out = mix((ends - starts).astype(np.uint64))
    left, at = ends - starts, starts.copy()
    rows = np.arange(len(starts))
    while len(rows):
        short = np.minimum(left[rows], 8).astype(np.uint64)
        lane = lanes[at[rows]] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * short))
        out[rows] = mix(out[rows] * BASE + lane)
        at[rows] += 8
        left[rows] -= 8
        rows = rows[left[rows] > 0]
    return out


def word_spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true; the last element must be false."""
    before = np.concatenate(([False], inside[:-1]))
    return np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
