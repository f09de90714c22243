"""A compressed full-text index over a sequence of small integers, for many searches at once."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` symbols that follow them, by doubling; shorter suffixes come first."""
    _, rank = np.unique(symbols, return_inverse=True)
    rank, step, n = rank.astype(np.uint64) + np.uint64(1), 1, len(symbols)
    order = np.argsort(rank, kind="stable")
    while step < depth and n and int(rank.max()) < n:
        next_ = np.zeros(n, np.uint64)
        next_[:n - step] = rank[step:]
        key = rank << np.uint64(32) | next_
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])).astype(np.uint64)
        step *= 2
    return order


class WaveletMatrix:
    """Rank of a symbol before a position, from one packed bit vector for each bit of the alphabet.

    A level stores its bits, 64 to a word, and the ones before each word: about 1.5 bits for each symbol and level.
    """

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        now = symbols
        for level in reversed(range(self.levels)):
            bit = (now >> level & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, bool)
            padded[:self.n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int32)
            self.words.append(words)
            self.before.append(np.cumsum(ones, dtype=np.int32) - ones)
            self.zeros.append(self.n - int(ones.sum()))
            now = np.concatenate([now[~bit], now[bit]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``position``, plus where the symbol begins in the last level."""
        for i in range(self.levels):
            word = position >> 6
            below = (np.uint64(1) << (position & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[i][word] + np.bitwise_count(self.words[i][word] & below)
            bit = (symbol >> (self.levels - 1 - i) & 1).astype(bool)
            position = np.where(bit, self.zeros[i] + ones, position - ones)
        return position


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols of the indexed sequence.

    What is kept is the wavelet matrix of the transformed sequence and where each symbol begins; the sequence itself and its
    suffix order are given up once the index stands.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        symbols = symbols.astype(np.int64)
        self.bwt = WaveletMatrix(symbols[suffix_order(symbols, depth) - 1])
        self.alphabet = int(symbols.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.alphabet))])
        self.base = self.bwt.rank(np.arange(self.alphabet), np.zeros(self.alphabet, np.int64))

    def extend(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The end of an interval after one more symbol to the left."""
        return self.first[symbol] + self.bwt.rank(symbol, position) - self.base[symbol]

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each end in a streamed ``text``, how many symbols to its left, up to ``most``, the index holds at ``least`` times, and their interval.

        These are matching statistics, each read from its end. The text may be any; a symbol that the index does not know ends a search.
        For a text that is part of the index, ``least`` is 2, as it finds itself.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.bwt.n, np.int64)
        active = np.arange(len(ends))
        for t in range(1, most + 1):
            active = active[ends[active] >= t]
            symbol = text[ends[active] - t]
            active, symbol = active[symbol < self.alphabet], symbol[symbol < self.alphabet]
            if t == 1:
                a, b = self.first[symbol], self.first[symbol + 1]
            else:
                both = self.extend(np.concatenate([symbol, symbol]), np.concatenate([low[active], high[active]]))
                a, b = both[:len(active)], both[len(active):]
            go = b - a >= least
            active = active[go]
            if not len(active):
                break
            low[active], high[active], length[active] = a[go], b[go], t
        return length, low, high
