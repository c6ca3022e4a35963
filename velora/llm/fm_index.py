"""A compressed full-text index over a sequence of integers: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np


#: The bits below each place of a 64-bit word.
BELOW = np.array([(1 << i) - 1 for i in range(64)], np.uint64)


class BitRank:
    """Bits in 64-bit words with a running count; ``ones(i)`` counts the ones before position i."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        self.words = np.frombuffer(np.pad(packed, (0, 16 - len(packed) % 8)).tobytes(), np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        return self.before.take(w, mode="clip") + np.bitwise_count(self.words.take(w, mode="clip") & BELOW.take(i & 63, mode="clip"))


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols.

    Holds fewer than 2**31 symbols.  Suffixes are sorted by their first ``depth`` symbols or more (prefix doubling), which is all that patterns of that
    length can see.  The last symbol must be one that no pattern holds.  Each level of the matrix holds one bit of every symbol, so the index takes N * log2(sigma) bits
    plus a half for the counts.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, span = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while True:
            new = np.empty(n, np.int64)
            key = rank[order]
            if span > 1:
                second = np.where(order + span // 2 < n, rank[np.minimum(order + span // 2, n - 1)] + 1, 0)
                step = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
            else:
                step = key[1:] != key[:-1]
            new[order] = np.concatenate([[0], np.cumsum(step)])
            rank = new
            if span >= depth or rank.max() == n - 1:
                break
            second = np.zeros(n, np.int64)
            second[: n - span] = rank[span:] + 1
            order = np.argsort(rank * (n + 1) + second, kind="stable")
            span *= 2
        bwt = text[order - 1]  # the symbol before each suffix; the first suffix follows the last symbol
        self.size, self.sigma = n, int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))]).astype(np.int64)
        self.bits = max(1, (self.sigma - 1).bit_length())
        self.levels: list[tuple[BitRank, int, int]] = []
        row, symbols, self.start = bwt.astype(np.int64), np.arange(self.sigma, dtype=np.int64), np.zeros(self.sigma, np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            vector, zeros = BitRank(bit), int(n - bit.sum())
            self.levels.append((vector, zeros, level))
            ones = vector.ones(self.start)
            self.start = np.where((symbols >> level) & 1, zeros + ones, self.start - ones)
            row = np.concatenate([row[bit == 0], row[bit == 1]])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for many patterns: the suffixes that start with the symbol and then the pattern."""
        both = np.stack([low, high])
        for vector, zeros, level in self.levels:
            ones = vector.ones(both)
            both = np.where((symbol >> level) & 1 == 1, ones + zeros, both - ones)
        both += (self.first[symbol] - self.start[symbol]).astype(np.int32)
        return both[0], both[1]

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """For each place: how many symbols up to and with it, ``most`` at most, stand at another place too.

        Backward search goes from the place to the left; it is given up as soon as one suffix is left, as that is the
        place's own.  ``most`` symbols must stand before the end of the text on the left.
        """
        out, at = np.full(len(ends), most), np.arange(len(ends))
        text = text.astype(np.int32)
        last = text[ends]
        low, high = self.first[last].astype(np.int32), self.first[last + 1].astype(np.int32)
        for length in range(1, most + 1):
            single = high - low <= 1
            out[at[single]] = length - 1
            if length == most:
                return out
            alive = ~single
            at, low, high = at[alive], low[alive], high[alive]
            if not len(at):
                return out
            low, high = self.extend(text[ends[at] - length], low, high)
        return out
