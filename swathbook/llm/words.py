"""Words of many texts at once, as 64-bit hashes, read off the UTF-8 bytes of an Arrow column.

A word is a run of ASCII letters, digits and characters beyond ASCII; A-Z are lower-cased. A byte table is enough for
that, since every byte of a longer UTF-8 character is 0x80 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text turned into words at once; a longer text is cut between two words.
CHUNK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Byte to folded byte (0: no word), and a random 64-bit value for each byte."""
    fold = np.zeros(256, np.uint8)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            fold[b] = b
        elif 0x41 <= b <= 0x5A:
            fold[b] = b + 32
    return fold, mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _span(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of the words of ``data``; no word crosses a row's start or end (rows not empty)."""
    fold, value = _tables()
    code = fold[data]
    word = code != 0
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[starts] = word[starts]
    last[ends - 1] = word[ends - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last)
    size = max(CHUNK_BYTES, 1 << int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.cumsum(value[code] * up[: len(data)], dtype=np.uint64)
    before = np.where(s > 0, total[s - 1], np.uint64(0))
    hashes = (total[e] - before) * down[s]
    return mix64(hashes + (e - s + 1).astype(np.uint64)), s, e + 1


def _cut(data: np.ndarray, begin: int, end: int) -> int:
    """A place up to CHUNK_BYTES after ``begin`` that is not inside a word (further if a word is longer)."""
    fold, _ = _tables()
    size = CHUNK_BYTES
    while begin + size < end:
        gaps = np.flatnonzero(fold[data[begin : begin + size]] == 0)
        if len(gaps):
            return begin + int(gaps[-1]) + 1
        size *= 2
    return end


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets in them; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


def words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, word hashes, bounds) for runs of whole rows; row i has hashes[bounds[i]:bounds[i + 1]]."""
    data, bounds = bytes_of(texts)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1)
        begin, end = int(bounds[row]), int(bounds[stop])
        if stop == row + 1 and end - begin > CHUNK_BYTES:
            parts = []
            while begin < end:
                cut = _cut(data, begin, end)
                parts.append(_span(data[begin:cut], np.array([0]), np.array([cut - begin]))[0])
                begin = cut
            hashes = np.concatenate(parts)
            yield row, hashes, np.array([0, len(hashes)])
        else:
            local = bounds[row : stop + 1] - begin
            filled = local[1:] > local[:-1]
            if not filled.any():
                yield row, np.zeros(0, np.uint64), np.zeros(stop - row + 1, np.int64)
            else:
                hashes, first, _ = _span(data[begin:end], local[:-1][filled], local[1:][filled])
                yield row, hashes, np.searchsorted(first, local)
        row = stop


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; fewer words, but not none, make one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(width, n)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x2545F4914F6CDD1D) + hashes[i : n - size + 1 + i]
    return mix64(out + np.uint64(size))
