"""A compressed FM-index over words, and matching statistics of streamed pieces against it.

The index keeps the Burrows-Wheeler transform of a collection of word sequences in a wavelet matrix of packed bits: rank queries
take one popcount for each bit of a word's number. Suffixes are sorted by their first 64 words, which is enough for
backward search of patterns up to that length. All pieces are searched at once, one word further to the left at each step.
"""

from __future__ import annotations

import numpy as np

#: Words by which suffixes are sorted; a pattern may be one word longer than the window.
DEPTH = 64


class WaveletMatrix:
    """rank of a symbol before a position, for arrays of symbols and positions."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        current = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            zeros = len(bit) - int(before[-1])
            self.levels.append((packed, before, zeros))
            current = np.concatenate((current[~bit], current[bit]))

    def down(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where a position ends up below the last level on the way of a symbol."""
        for i, (packed, before, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - i)) & 1).astype(bool)
            word, rest = position >> 6, (position & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << rest) - np.uint64(1))).astype(np.int64)
            position = np.where(one, zeros + ones, position - ones)
        return position


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    _, rank = np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)
    return rank


class FMIndex:
    """``text`` holds the words' numbers from 1 on, with a 0 after each piece; ``owner`` a number for each position."""

    def __init__(self, text: np.ndarray, owner: np.ndarray, window: int):
        n = len(text)
        self.window = window
        rank, by_length = text.astype(np.int64), {1: text.astype(np.int64)}
        length = 1
        while length < DEPTH:
            follow = np.zeros(n, np.int64)
            follow[: n - length] = rank[length:] + 1
            rank = _ranked(rank, follow)
            length *= 2
            by_length[length] = rank
        order = np.argsort(rank, kind="stable")
        sigma = int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        bits = max(1, int(sigma - 1).bit_length())
        self.matrix = WaveletMatrix(text[order - 1], bits)
        self.base = self.matrix.down(np.arange(sigma), np.zeros(sigma, np.int64))
        # suffixes that agree in a whole window, and the least owner among them
        half = 1 << (window.bit_length() - 1)
        follow = np.zeros(n, np.int64)
        follow[: n - (window - half)] = by_length[half][window - half :] + 1
        whole = _ranked(by_length[half], follow)[order]
        edge = np.concatenate(([True], whole[1:] != whole[:-1]))
        self.start = np.flatnonzero(edge)
        self.end = np.append(self.start[1:], n)
        self.group = np.cumsum(edge) - 1
        self.least = np.minimum.reduceat(owner[order], self.start)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the symbol and go on with one of low..high."""
        shift = self.before[symbol] - self.base[symbol]
        return self.matrix.down(symbol, low) + shift, self.matrix.down(symbol, high) + shift

    def least_owners(self, text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For every window of the pieces (text[begin : begin + size]), piece by piece: the least owner of a match.

        Matching statistics by backward search: the match is extended by one word to the left; as soon as it is as long
        as the window it is reported, and before the next step it gives up what is beyond the window. A window that is
        not in the index gets the largest number.
        """
        windows = np.maximum(size - self.window + 1, 0)
        offset = np.cumsum(windows) - windows
        out = np.full(int(windows.sum()), np.iinfo(np.int64).max)
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), len(self.group))
        length = np.zeros(len(begin), np.int64)
        alive = np.flatnonzero(size >= self.window)
        for step in range(int(size.max(initial=0))):
            alive = alive[size[alive] > step]
            if not len(alive):
                break
            symbol = text[begin[alive] + size[alive] - 1 - step]
            a, b = self.extend(symbol, low[alive], high[alive])
            lost = a >= b
            a[lost], b[lost] = 0, len(self.group)
            grown = np.where(lost, 0, length[alive] + 1)
            full = np.flatnonzero(grown >= self.window)
            group = self.group[a[full]]
            at = alive[full]
            out[offset[at] + size[at] - 1 - step] = self.least[group]
            a[full], b[full] = self.start[group], self.end[group]
            grown[full] = self.window
            low[alive], high[alive], length[alive] = a, b, grown
        return out
