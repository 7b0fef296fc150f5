"""FM-index over a sequence of small integer symbols, in numpy.

Symbol 0 separates runs; phrases are searched inside runs only. The index is
a Burrows-Wheeler transform with ranks from a wavelet matrix (one packed bit
vector per symbol bit, with block counts), plus suffix positions sampled
every ``sample`` symbols and at every run's first symbol. All phrases of one
length step through the backward search together.
"""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; separators differ by place,
    so comparisons end with the run. Only suffixes still tied are sorted again."""
    n = len(seq)
    key = seq.astype(np.int64)
    sep = np.flatnonzero(key == 0)
    rank = key + len(sep)
    rank[sep] = np.arange(len(sep))
    order = np.argsort(rank, kind="stable")
    rank = _ranks(rank[order], order)
    width = 1
    while True:
        ordered = rank[order]
        tied = np.zeros(n, dtype=bool)
        same = ordered[1:] == ordered[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        places = np.flatnonzero(tied)
        if not len(places):
            return order
        suffixes = order[places]
        nxt = suffixes + width
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1)
        # a tie's members have consecutive places and a rank of their own, so they stay together
        by = np.lexsort((second, rank[suffixes]))
        order[places] = suffixes[by]
        first, second = rank[suffixes[by]], second[by]
        new_group = np.ones(len(places), dtype=bool)
        new_group[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank = rank.copy()
        rank[suffixes[by]] = places[np.maximum.accumulate(np.where(new_group, np.arange(len(places)), 0))]
        width *= 2


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of each suffix: the place at which its equal group begins."""
    first = np.ones(len(ordered), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(ordered), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    return rank


class Bits:
    """Bit vector with constant-time rank: words of 64 bits and counts before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, n_bits: int):
        self.levels, self.zeros, self.n_bits = [], [], n_bits
        cur = seq
        for b in range(n_bits - 1, -1, -1):
            bit = (cur >> b) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(cur) - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i`` values."""
        start = np.zeros_like(i)
        end = i
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = ((symbol >> (self.n_bits - 1 - level)) & 1).astype(bool)
            s, e = bits.rank1(start), bits.rank1(end)
            start = np.where(one, zeros + s, start - s)
            end = np.where(one, zeros + e, end - e)
        return end - start

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            one = bits.get(i).astype(np.int64)
            ones = bits.rank1(i)
            i = np.where(one == 1, zeros + ones, i - ones)
            out = out * 2 + one
        return out


class FMIndex:
    def __init__(self, seq: np.ndarray, n_symbols: int, sample: int = 16):
        """``seq`` must end with a separator; ``n_symbols`` counts symbol 0."""
        seq = seq.astype(np.int64)
        sa = suffix_array(seq)
        last = seq[sa - 1]  # the separator at the end comes before the first symbol
        self.n = len(seq)
        self.first = np.zeros(n_symbols + 1, dtype=np.int64)
        np.cumsum(np.bincount(seq, minlength=n_symbols), out=self.first[1:])
        self.bwt = WaveletMatrix(last, max(1, int(n_symbols - 1).bit_length()))
        kept = (sa % sample == 0) | (last == 0)
        self.sampled = Bits(kept)
        self.positions = sa[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval ``[lo, hi)`` of every row of ``phrases`` (equal lengths)."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.n, dtype=np.int64)
        for column in phrases.T[::-1]:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            c = column[live]
            lo[live], hi[live] = self.first[c] + self.bwt.rank(c, lo[live]), self.first[c] + self.bwt.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: step back until a sampled position."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        live = np.arange(len(rows))
        while True:
            live = live[self.sampled.get(at[live]) == 0]
            if not len(live):
                return self.positions[self.sampled.rank1(at)] + steps
            c = self.bwt.access(at[live])
            at[live] = self.first[c] + self.bwt.rank(c, at[live])
            steps[live] += 1
