"""Words, lines and hashes of many texts at once, as numpy arrays over an Arrow column.

Texts are seen as UTF-8 bytes. A word is a longest run of bytes other than the six
ASCII white-space characters (space and 0x09 to 0x0D). Work is cut into chunks of
about half a million bytes, so memory does not depend on batch sizes; a longer text is a
chunk of its own and only its words' hashes are kept, block by block.

Hashes are sums of a random 64-bit value per byte times a power of an odd number,
modulo 2**64, mixed at the end. Two given different strings have the same hash with a
chance of about 2**-60; nothing here defends against texts made to collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)

WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(_BASE) + _U(seed))


_BYTE_VALUE = stream(256, 7)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse; kept for the next call."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[i] the hash sum of the first i bytes."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the same wherever the bytes stand (not mixed yet)."""
    _, down = powers(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them); nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]
        first = last


@dataclass
class Words:
    """Words of a chunk in order: byte places, row of each, and how many each row has."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    counts: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        """Index of each row's first word."""
        return np.cumsum(self.counts) - self.counts


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = WORD_BYTE[data]
    n = len(data)
    bounds = offsets[(offsets > 0) & (offsets < n)]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[bounds] = inside[bounds]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Words(starts, ends, rows, np.bincount(rows, minlength=len(offsets) - 1))


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    """A mixed hash of each word's bytes, taken block by block."""
    out = np.empty(len(found.starts), np.uint64)
    first = 0
    while first < len(out):
        last = int(np.searchsorted(found.starts, found.starts[first] + CHUNK_BYTES, side="left"))
        base, stop = found.starts[first], found.ends[last - 1]
        sums = prefix_hashes(data[base:stop])
        starts, ends = found.starts[first:last] - base, found.ends[first:last] - base
        out[first:last] = mix(span_hashes(sums, starts, ends) + (ends - starts).astype(np.uint64))
        first = last
    return out


_PLACES = stream(64, 11)
_SHORT = stream(64, 13)


def shingles(hashes: np.ndarray, found: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words, in order.

    A row with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        total[: n - k] += hashes[k:] * _PLACES[k]
    full = np.zeros(n, bool)
    if n >= width:
        full[: n - width + 1] = found.rows[: n - width + 1] == found.rows[width - 1 :]
    values, rows = mix(total[full]), found.rows[full]
    short = np.flatnonzero((found.counts > 0) & (found.counts < width))
    if len(short):
        sums = _SHORT[found.counts[short]].copy()
        for k in range(width - 1):
            has = found.counts[short] > k
            sums[has] += hashes[found.firsts[short[has]] + k] * _PLACES[k]
        values = np.concatenate([values, mix(sums)])
        rows = np.concatenate([rows, short])
    return values, rows


def sort_within_rows(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Order by row, then key."""
    order = np.argsort(keys)
    kind = np.uint16 if n_rows <= 1 << 16 else np.int64
    return order[np.argsort(rows[order].astype(kind), kind="stable")]


def distinct_within_rows(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and rows ordered by both, each pair once."""
    order = sort_within_rows(keys, rows, n_rows)
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], rows[new]


def sums_by_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum modulo 2**64 of the values of each row; rows come in order."""
    out = np.zeros(n_rows, np.uint64)
    if len(values):
        heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[heads]] = np.add.reduceat(values, heads)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
