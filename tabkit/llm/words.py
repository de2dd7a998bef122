"""Words of whole texts as numpy arrays: the shared step of the operators that read text in Arrow batches.

A batch is cut into pieces of whole rows of about PIECE_BYTES, so a task's memory follows the piece (or one
very long text), not the batch. Words are found from a table of 256 bytes; every pattern used here is a set of
ASCII separators, so working on UTF-8 bytes gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

U = np.uint64
_rng = np.random.default_rng(20240611)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))

SPACES = np.ones(256, dtype=bool)  # [^\x20\x09-\x0D]+
SPACES[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; kept per worker and grown on demand."""
    if len(_powers[0]) < n:
        size = 1 << int(np.ceil(np.log2(n)))
        with np.errstate(over="ignore"):
            for k, b in enumerate((BASE, BASE_INVERSE)):
                steps = np.full(size, b, dtype=np.uint64)
                steps[0] = 1
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for every span, from running polynomial sums."""
    n = len(values)
    up, down = powers(n + 1)
    with np.errstate(over="ignore"):
        c = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * up[:n], out=c[1:])
        h = (c[ends] - c[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is the empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of rows [row0, row0 + rows) of a batch."""

    row0: int
    rows: int
    data: np.ndarray  # the piece's bytes, lower-cased if asked
    at: np.ndarray  # rows + 1 byte offsets
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # rows + 1 word offsets

    def hashes(self) -> np.ndarray:
        return spans_hash(BYTE_VALUE[self.data], self.starts, self.ends)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))


def split_words(data: np.ndarray, at: np.ndarray, table: np.ndarray, row0: int = 0, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    inside = table[data]
    n = len(data)
    edge = at[1:-1]
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edge[edge < n]] = False
    after[edge[edge > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(row0, len(at) - 1, data, at, starts, ends, np.searchsorted(starts, at))


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole rows of about limit bytes."""
    data, at = utf8(column)
    n, row = len(at) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words_of(column: pa.Array, table: np.ndarray = SPACES, lower: bool = False, limit: int = PIECE_BYTES) -> Iterator[Words]:
    for row, data, at in pieces(column, limit):
        yield split_words(data, at, table, row, lower)


def grams(hashes: np.ndarray, first: np.ndarray, k: int, whole_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, starting word) of every run of k words inside a row.

    With whole_short a row of 1 to k-1 words gives its whole sequence as one run.
    """
    counts = np.diff(first)
    runs = np.maximum(counts - k + 1, 0)
    if whole_short:
        runs = np.where((counts > 0) & (runs == 0), 1, runs)
    row = np.repeat(np.arange(len(counts)), runs)
    start = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs) + first[:-1][row]
    end = np.minimum(start + k, first[1:][row])
    return spans_hash(hashes, start, end), row, start


def as_long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
