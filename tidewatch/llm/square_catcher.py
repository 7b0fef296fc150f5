"""Periodic runs of words by online dyadic square catching.

``Catchers`` reads a stream of words. At level ``j`` every completed block of
``2**j`` words that starts at a multiple of ``2**j`` is a catcher for periods
from ``2**j`` to ``2**(j+1) - 1``. Each appended word completes one suffix of
``2**j`` words per level, and exactly one catcher lies at such a distance from
it, so a word costs one comparison a level: the suffix's hash against the
catcher's. A run that holds its period ``p`` three times or more repeats some
whole block of its level at distance ``p``, hence none is missed. Equal
comparisons of one period on consecutive blocks are one match; its ends come
from longest common extensions, a match of ``p`` words or more is a square, and
squares of a period that overlap merge into one run. Matches that reach the end
of the stream stay open and go on with the next words.

Hashes of ``2**(j+1)`` words come from two of ``2**j`` (not from a polynomial
modulo ``2**64``, which Thue-Morse words defeat); extensions compare sums
modulo two primes, and every run is confirmed on the words' own hashes.

Spark deals the documents; a task appends the documents of a block of text to
one stream, each closed by a word that occurs nowhere else. Memory follows the
block (one longer text is a block of its own), not the partition.

Edge cases: null and empty texts have no word and no run; repeated rows and
null keys count each; an empty table gives an empty result; extra columns are
ignored (``keep`` carries the wanted ones, whatever their names).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.words import NON_SPACE, blocks, mix, span_hashes, word_spans

LEAST_LENGTH, LEAST_TIMES = 24, 3
_CHUNK = 1 << 20
_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = (1_000_003, 998_244_353)


class _Sums:
    """Running sums of ``word * base**position`` modulo two primes, for comparing ranges."""

    def __init__(self, words: np.ndarray):
        self.sums = []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            out = np.zeros(len(words) + 1, dtype=np.uint32)
            powers, carry, shift = _power_run(base, prime, min(_CHUNK, len(words))), 0, 1
            for k in range(0, len(words), _CHUNK):
                part = words[k: k + _CHUNK] % np.uint64(prime)
                part = part * powers[: len(part)] % np.uint64(prime) * np.uint64(shift) % np.uint64(prime)
                run = (np.cumsum(part) + np.uint64(carry)) % np.uint64(prime)
                out[k + 1: k + 1 + len(part)] = run
                carry, shift = int(run[-1]), shift * pow(base, len(part), prime) % prime
            self.sums.append(out)

    def equal(self, x: np.ndarray, p: np.ndarray, m: np.ndarray, shifts: list[np.ndarray]) -> np.ndarray:
        """Whether the ``m`` words at ``x`` are those at ``x + p``; ``shifts`` from :meth:`shifts`."""
        same = np.ones(len(x), dtype=bool)
        for total, prime, shift in zip(self.sums, _PRIMES, shifts, strict=True):
            here = total[x + m].astype(np.int64) - total[x]
            there = total[x + p + m].astype(np.int64) - total[x + p]
            same &= (here % prime) * shift % prime == there % prime
        return same

    @staticmethod
    def shifts(p: np.ndarray) -> list[np.ndarray]:
        """``base**p`` for each prime."""
        out = []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            result, square, left = np.ones(len(p), dtype=np.int64), base, p.copy()
            while left.any():
                odd = (left & 1).astype(bool)
                result[odd] = result[odd] * square % prime
                square = square * square % prime
                left >>= 1
            out.append(result)
        return out


def _power_run(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    m = 1
    while m < n:
        out[m: 2 * m] = out[: min(m, n - m)] * np.uint64(pow(base, m, prime)) % np.uint64(prime)
        m *= 2
    return out


class Catchers:
    """``append`` words; ``runs()`` are the closed runs so far, ``finish()`` closes all.

    ``longest`` may give the length of the longest stretch that can hold a run
    (such as the longest document of a stream of documents)."""

    def __init__(self, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, longest: int | None = None):
        if least_times < 3:
            raise ValueError("blocks are only sure to be caught in runs of three periods or more")
        self.least_length, self.least_times, self.longest = least_length, least_times, longest
        self.words = np.zeros(0, dtype=np.uint64)
        self._levels: list[tuple[int, np.ndarray]] = []  # position of the first kept window hash, hashes
        self._open = np.zeros((0, 3), dtype=np.int64)  # matches that reach the end: first, end, period
        self._closed: list[np.ndarray] = []  # runs: start, end, period

    def append(self, words: np.ndarray, last: bool = False) -> np.ndarray:
        """Reads ``words`` and returns the squares they reveal, one row
        ``(start, period)`` per match that newly holds one (its first square).
        A square is told once a whole block of its level is repeated, less
        than a block's words after its end."""
        self.words = np.concatenate([self.words, words]) if len(self.words) else words
        n = len(self.words)
        found, lower, j = [self._open], None, 0
        while (1 << j) <= n and (self.longest is None or (self.least_times << j) <= self.longest):
            lower = self._advance(j, lower, found, keep=not last)
            j += 1
        matches = np.concatenate(found)
        known = {(int(a), int(p)) for a, e, p in self._open if e - a >= p}
        self._open = np.zeros((0, 3), dtype=np.int64)
        if not len(matches):
            return np.zeros((0, 2), dtype=np.int64)
        matches = self._extend(matches)
        at_end = matches[:, 1] + matches[:, 2] == n
        if not last:
            self._open = matches[at_end]
            self._close(matches[~at_end])
        else:
            self._close(matches)
        squares = matches[matches[:, 1] - matches[:, 0] >= matches[:, 2]][:, [0, 2]]
        return np.array([s for s in squares.tolist() if tuple(s) not in known], dtype=np.int64).reshape(-1, 2)

    def _advance(self, j: int, lower, found: list[np.ndarray], keep: bool) -> tuple[int, np.ndarray]:
        """Hashes of the new suffixes of ``2**j`` words, compared with their catchers."""
        block = 1 << j
        base, old = self._levels[j] if j < len(self._levels) else (0, np.zeros(0, dtype=np.uint64))
        begin, end = base + len(old), len(self.words) - block + 1
        if j == 0:
            fresh = self.words[begin:end]
        else:
            below, half = lower[0], block >> 1
            fresh = mix(lower[1][begin - below: end - below] * np.uint64(0x9FB21C651E98DF25) + lower[1][begin + half - below: end + half - below])
        hashes = np.concatenate([old, fresh]) if len(old) else fresh
        hits = []
        for k in range(max(begin, block), end, _CHUNK):
            at = np.arange(k, min(k + _CHUNK, end))
            catcher = (at >> j << j) - block
            same = np.flatnonzero(hashes[at - base] == hashes[catcher - base])
            if len(same):
                hits.append(np.stack([catcher[same], at[same] - catcher[same]], axis=1))
        if hits:
            found.append(_joined(np.concatenate(hits), block))
        if keep:  # the next words need the suffixes of four blocks
            skip = max(0, len(hashes) - 4 * block)
            kept = (base + skip, hashes[skip:].copy())
            self._levels[j: j + 1] = [kept]
        return base, hashes

    def _extend(self, matches: np.ndarray) -> np.ndarray:
        """Matches drawn out to both sides as far as words repeat, each once."""
        sums, n = _Sums(self.words), len(self.words)
        first, end, p = matches.T
        shifts = sums.shifts(p)

        def furthest(limit: np.ndarray, test) -> np.ndarray:
            low, high = np.zeros(len(limit), dtype=np.int64), limit
            while (low < high).any():
                middle = (low + high + 1) >> 1
                same = test(middle)
                low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
            return low

        right = furthest(n - p - end, lambda m: sums.equal(end, p, m, shifts))
        left = furthest(first.copy(), lambda m: sums.equal(first - m, p, m, shifts))
        return np.unique(np.stack([first - left, end + right, p], axis=1), axis=0)

    def _close(self, matches: np.ndarray) -> None:
        first, end, p = matches.T
        length = end - first + p
        long = matches[length >= np.maximum(self.least_length, self.least_times * p)]
        runs = _smallest(np.stack([long[:, 0], long[:, 1] + long[:, 2], long[:, 2]], axis=1))
        for a, e, p in runs.tolist():
            if not np.array_equal(self.words[a: e - p], self.words[a + p: e]):
                raise ArithmeticError("two different stretches of words have equal sums")
        self._closed.append(runs)

    def finish(self) -> np.ndarray:
        self._close(self._open)
        self._open = self._open[:0]
        return self.runs()

    def runs(self) -> np.ndarray:
        """Rows ``(start, length, period)`` by start, then period."""
        if not self._closed:
            return np.zeros((0, 3), dtype=np.int64)
        runs = _smallest(np.concatenate(self._closed))
        runs[:, 1] -= runs[:, 0]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of ``(start, end, period)`` that cover the same words, the one of the
    smallest period: the other periods are its multiples."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def _joined(hits: np.ndarray, block: int) -> np.ndarray:
    """Matches ``(first, end, period)`` from hits ``(catcher, period)``: hits of one period on consecutive blocks are one."""
    hits = hits[np.lexsort((hits[:, 0], hits[:, 1]))]
    new = np.ones(len(hits), dtype=bool)
    new[1:] = (hits[1:, 1] != hits[:-1, 1]) | (hits[1:, 0] != hits[:-1, 0] + block)
    begin = np.flatnonzero(new)
    final = np.r_[begin[1:], len(hits)] - 1
    return np.stack([hits[begin, 0], hits[final, 0] + block, hits[begin, 1]], axis=1)


def text_runs(buf: np.ndarray, offs: np.ndarray, **options) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Runs of each text, and the spans of its words (starts, ends, first word of each text)."""
    starts, ends, first = word_spans(buf, offs, NON_SPACE)
    n = len(offs) - 1
    closing = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    stream = np.insert(span_hashes(buf, starts, ends), first[1:], closing)
    catchers = Catchers(longest=int(np.diff(first).max(initial=0)), **options)
    catchers.append(stream, last=True)
    runs = catchers.runs()
    begin = first[:-1] + np.arange(n)  # of each text in the stream
    text = np.searchsorted(begin, runs[:, 0], side="right") - 1
    runs[:, 0] -= begin[text]
    return np.split(runs, np.searchsorted(text, np.arange(1, n))), starts, ends, first


def dropped_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(step[:-1]) > 0


def _collapsed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, runs: np.ndarray) -> bytes:
    """The kept words joined by one space, gathered by stretches of words."""
    n = len(starts)
    if not n:
        return b""
    if not len(runs):
        bounds = [(0, n)]
    else:
        kept = np.r_[False, ~dropped_words(runs, n), False]
        turns = np.flatnonzero(kept[1:] != kept[:-1])
        bounds = list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))
    out = []
    for a, b in bounds:
        for k in range(a, b, 1 << 16):
            out.append(b" ".join(buf[starts[k]: ends[min(k + (1 << 16), b) - 1]].tobytes().split()))
    return b" ".join(out)


def greatest(runs: np.ndarray) -> int | None:
    """Index of the run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for k, (_, length, period) in enumerate(runs.tolist()):
        if best is None or length * int(runs[best, 2]) > int(runs[best, 1]) * period:
            best = k
    return best


RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _structs(rows: np.ndarray, mask: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in rows.T], fields=list(_RUN_TYPE),
                                      mask=None if mask is None else pa.array(mask))


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES) -> DataFrame:
    """``keep``, ``n_words``, ``runs`` (by start, then period), ``greatest`` (the
    run of most periods) and ``collapsed`` (the text without repeated periods,
    words joined by one space) of every row's whole text."""
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("body"))
    kinds = dict(source.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            for i, j, buf, offs in blocks(batch.column("body")):
                found, starts, ends, first = text_runs(buf, offs, least_length=least_length, least_times=least_times)
                best = [greatest(r) for r in found]
                top = np.array([[0, 0, 0] if b is None else r[b] for r, b in zip(found, best, strict=True)], dtype=np.int64)
                short = [_collapsed(buf, starts[a:b], ends[a:b], r) for a, b, r in zip(first[:-1].tolist(), first[1:].tolist(), found, strict=True)]
                sizes = np.r_[0, np.cumsum([len(r) for r in found])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in names), pa.array(np.diff(first), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(sizes), _structs(np.concatenate(found))),
                     _structs(top, np.array([b is None for b in best])), pa.array(short, pa.binary()).cast(pa.string())],
                    names=[*names, "n_words", "runs", "greatest", "collapsed"])

    out = source.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in names), f"n_words long, runs array<{RUN}>, greatest {RUN}, collapsed string"]))
    return out.toDF(*keep, "n_words", "runs", "greatest", "collapsed")
