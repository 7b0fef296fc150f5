"""Words of many texts at once, as numpy arrays.

A batch of Arrow strings is one byte buffer plus offsets, so words, their
64-bit hashes and their counts come from a few array operations per block of
text instead of a Python loop over words. Blocks hold whole texts and about
``BLOCK_BYTES`` of them (one longer text is a block of its own), which bounds
a task's memory whatever the batch size.

Words are maximal runs of the bytes a boolean table marks; both classes used
here only tell ASCII characters apart, so UTF-8 bytes give the same words as
code points. A null text is an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

#: fixed values: word characters of ``[^\x20\x09-\x0D]+``
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: fixed values: word characters of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z)
ALNUM = np.ones(256, dtype=bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
#: ASCII lower-casing
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (xor-shift-multiply finalizer)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
PIECE_BYTES = 1 << 18
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None:
        def table(base: int) -> np.ndarray:
            p = np.full(PIECE_BYTES + 1, base, dtype=np.uint64)
            p[0] = 1
            return np.multiply.accumulate(p)

        _powers = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _powers


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span: differences of one running polynomial
    sum, moved to a common power, so the cost is one pass over the bytes.
    Neither starts nor ends may fall. The bytes go through in pieces of whole
    spans, so memory beyond the result does not grow with the text."""
    up, down = _power_tables()
    out = np.empty(len(starts), dtype=np.uint64)
    total = np.zeros(PIECE_BYTES + 1, dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + PIECE_BYTES, side="right"))
        if j <= i:
            out[i] = _long_span(buf[base: int(ends[i])], up)
            i += 1
            continue
        piece = buf[base: int(ends[j - 1])]
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=total[1: len(piece) + 1])
        first = starts[i:j] - base
        out[i:j] = (total[ends[i:j] - base] - total[first]) * down[first]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def _long_span(span: np.ndarray, up: np.ndarray) -> np.uint64:
    """Polynomial sum of a span longer than a piece."""
    total = 0
    for k in range(0, len(span), PIECE_BYTES):
        piece = span[k: k + PIECE_BYTES]
        total += int(np.sum(_BYTE[piece] * up[: len(piece)], dtype=np.uint64)) * pow(_BASE, k, 1 << 64)
    return np.uint64(total % (1 << 64))


def blocks(texts: pa.Array, block_bytes: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last + 1, bytes, offsets)`` for consecutive runs of texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[texts.offset: texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    limit, i = block_bytes or BLOCK_BYTES, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j, raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def word_spans(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its
    first word (one more entry for the end). Words never cross texts."""
    n = len(buf)
    inside = table[buf]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def code_points(buf: np.ndarray) -> np.ndarray:
    """Running number of code points before each byte (one more entry for the end)."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; empty ranges give 0."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct sorted hashes of all runs of ``width`` words; a shorter, not
    empty text is one shingle of all its words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    k = min(width, n)
    h = words[: n - k + 1].copy()
    for j in range(1, k):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[j: n - k + 1 + j])
    return np.unique(mix(h + np.uint64(k)))


def tidy(run: Callable) -> Callable:
    """A batch function whose task gives its freed memory back to the machine.
    Python workers outlive their tasks, and what they keep counts against the
    stages that follow."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library: nothing to trim
                pass

    return wrapped
