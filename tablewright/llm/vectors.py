"""Word and shingle hashes of Arrow text columns, computed a few megabytes at a time with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
STEP_BYTES = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]  # one value for both cases of A-Z
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, STEP_BYTES)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, b, U64)]))
                                      for b in (_BASE, _BASE_INV))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_steps(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows with about STEP_BYTES of text; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP_BYTES, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z as a-z) and the index of each row's first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _POWERS.get(len(data))
    sums = np.cumsum(_BYTE[data] * up)
    before = np.where(s > 0, sums[np.maximum(s, 1) - 1], U64(0))
    hashes = mix((sums[e - 1] - before) * down[s] + (e - s).astype(U64))
    return hashes, np.searchsorted(s, offsets)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct hashes of its word shingles)``; a row with fewer words has the one
    shingle of all its words, a row without words an empty set."""
    for first, data, offsets in text_steps(column):
        words, at = word_hashes(data, offsets)
        if len(words) >= size:
            joined = words[:len(words) - size + 1].copy()
            for j in range(1, size):
                joined = mix(joined + U64(j)) + words[j:len(words) - size + 1 + j]
            joined = mix(joined)
        for i in range(len(offsets) - 1):
            a, b = int(at[i]), int(at[i + 1])
            if b - a >= size:
                yield first + i, np.unique(joined[a:b - size + 1])
            elif b > a:
                one = np.full(1, 0x5851F42D4C957F2D + b - a, U64)
                for w in words[a:b]:
                    one = mix(one + w)
                yield first + i, one
            else:
                yield first + i, np.zeros(0, U64)
