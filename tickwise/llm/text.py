"""Text columns of Arrow batches as byte arrays: chunks, words, word and shingle hashes.

Everything works on UTF-8 bytes with numpy, a bounded piece of a batch at a time, so a task
holds a few times ``CHUNK_BYTES`` (or the one text longer than that) besides its Arrow batch.
Words are maximal runs of bytes other than space and the controls 0x09-0x0D; these are ASCII,
so cutting at them never splits a code point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

# Odd base of the polynomial hash modulo 2**64 and its inverse (odd numbers are invertible).
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES["up"], _TABLES["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("").cast(pa.large_binary())
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if len(col) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[at[0]:at[-1]], at - at[0]


def strings_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=at[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), at


def row_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges of at most ``most`` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_runs(texts: list[str], most: int = CHUNK_BYTES):
    """Lists of consecutive texts of about ``most`` characters."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a row boundary ends a word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SEP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (spans in ascending order, not overlapping)."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(end, start[i] + CHUNK_BYTES, side="right"))
        j = max(j, i + 1)
        a, b = int(start[i]), int(end[j - 1])
        up, down = _tables(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[:b - a], dtype=np.uint64, out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix64(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the index of each row's first word (n + 1)."""
    start, end = word_spans(data, offsets)
    return span_hashes(data, start, end), start, end, np.searchsorted(start, offsets, side="left")


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; entry i covers words i .. i+k-1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
    return mix64(out)


def row_shingles(words: np.ndarray, first: np.ndarray, k: int):
    """Per row the hashes of its ``k``-word shingles in order; a row of fewer words has its whole
    sequence as one, a row without words none."""
    grams = gram_hashes(words, k)
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            yield grams[a:b - k + 1]
        else:
            yield gram_hashes(words[a:b], b - a) if b > a else words[:0]
