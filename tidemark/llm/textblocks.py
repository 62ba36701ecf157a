"""Texts of Arrow batches as flat arrays of bytes, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 19


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (from 0) of a string array without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, width, len(texts) + 1, texts.offset * width().itemsize).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of at most ``limit`` bytes of text or one row, each with its bytes and offsets."""
    raw, offsets = flat(batch.column(column))
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield batch.slice(start, stop - start), raw[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (murmur3's finalizer)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random 64-bit number for each byte after lower-casing A-Z.
_CODE = mix(np.arange(1, 257, dtype=np.uint64))[_LOWER]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word's index for each text (with one more at the end).

    Words are maximal runs without white space, A-Z lower-cased; a text's end
    ends its last word. The hash is a polynomial over random codes of the bytes.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.multiply(_CODE[raw], up[:n], out=total[1:])
    np.add.accumulate(total, out=total)
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)), np.searchsorted(first, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes (uint64) of its ``size``-word shingles.

    A text with fewer words has its whole sequence as one; without words, none.
    """
    hashed, at = words(raw, offsets)
    n = max(0, len(hashed) - size + 1)
    run = np.zeros(n, np.uint64)
    for k in range(size):
        run = run * np.uint64(_BASE) + hashed[k : k + n]
    run = mix(run)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            yield np.unique(run[a : b - size + 1])
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in hashed[a:b]:
                    one = one * np.uint64(_BASE) + h
            yield mix(np.array([one]))
        else:
            yield np.zeros(0, np.uint64)
