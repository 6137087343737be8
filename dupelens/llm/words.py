"""Words and word shingles of whole batches of texts as 64-bit hashes, computed with numpy on the UTF-8 bytes.

A word is a longest run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Word hashes are differences of
one running polynomial over the batch, so no Python object is made for a word. Two different words or shingles
share a hash with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept for the next batch."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of each hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, all rows behind each other, and where each row begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(at: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each; a longer row is alone."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def word_spans(data: np.ndarray, at: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each row the index of its first word (one more at the end)."""
    word = table[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    begins = at[:-1][at[:-1] < at[1:]]
    first[begins] = word[begins]
    inner = begins[begins > 0]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, at: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the rows, and for each row the index of its first word; ``table`` says which
    bytes belong to words."""
    data = LOWER[raw]
    starts, ends, rows = word_spans(data, at, table)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), rows


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence where it is shorter; none without words."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = words[: n - size + 1].copy()
    for i in range(1, size):
        out = out * STEP + words[i : n - size + 1 + i]
    return mixed(out)


def row_shingles(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles in order, repeats included."""
    raw, at = utf8(column)
    for first, last in chunks(at):
        part = at[first : last + 1]
        words, rows = word_hashes(raw[part[0] : part[-1]], part - part[0])
        for i in range(last - first):
            yield shingles(words[rows[i] : rows[i + 1]], size)
