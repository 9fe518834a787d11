"""A compressed FM-index over word sequences: suffix array, BWT in a wavelet matrix, matching statistics by backward search."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector, packed, with a rank directory of one count for each 64 bits."""

    def __init__(self, flags: np.ndarray):
        words = np.zeros(len(flags) // 64 + 1, dtype=np.uint64)
        packed = np.packbits(flags, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.uint32)
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w, b = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & ((np.uint64(1) << b) - np.uint64(1)))


class WaveletMatrix:
    """Rank of any symbol in log2(symbols) bit ranks; n * log2(symbols) bits and their directories."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels = []
        row = symbols
        for level in reversed(range(self.depth)):
            bit = (row >> level) & 1 == 1
            self.levels.append((Bits(bit), int(len(row) - np.count_nonzero(bit))))
            row = np.concatenate([row[~bit], row[bit]])

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before lo and before hi."""
        start = np.zeros(len(symbol), dtype=np.int64)
        ends = np.concatenate([start, lo, hi])
        n = len(symbol)
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels, strict=True):
            ones = bits.rank(ends)
            on = np.tile((symbol >> level) & 1 == 1, 3)
            ends = np.where(on, zeros + ones, ends - ones)
        return ends[n : 2 * n] - ends[:n], ends[2 * n :] - ends[:n]


class FMIndex:
    """Index of several sequences of 64-bit words. Each ends with a separator of its own, which no pattern has."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(lengths + 1)])
        n = int(self.start[-1])
        words = np.concatenate(sequences) if len(sequences) else np.empty(0, np.uint64)
        self.alphabet, code = np.unique(words, return_inverse=True)
        text = np.empty(n, dtype=np.int64)
        ends = self.start[1:] - 1
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[ends] = np.arange(len(sequences))
        text[inside] = code + len(sequences)
        self.first_word = len(sequences)
        self.n = n

        # prefix doubling; a suffix is unique once it holds a separator
        ranks, depth, rank = [], 1, text
        longest = int(lengths.max(initial=0)) + 1
        while True:
            ranks.append(rank)
            if depth >= longest:
                break
            after = np.zeros(n, dtype=np.int64)
            after[:-depth] = rank[depth:] + 1
            _, rank = np.unique(rank * np.int64(n + len(self.alphabet) + len(sequences) + 2) + after, return_inverse=True)
            depth *= 2
        self.sa = np.argsort(rank, kind="stable")
        self.lcp = self._lcp(ranks)
        bwt = text[self.sa - 1]
        n_symbols = len(sequences) + len(self.alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.wavelet = WaveletMatrix(bwt, n_symbols)

    def _lcp(self, ranks: list[np.ndarray]) -> np.ndarray:
        """Words that each suffix shares with the one before it in order, from the ranks of all depths, largest first."""
        lcp = np.zeros(self.n + 1, dtype=np.int64)
        if self.n > 1:
            a, b = self.sa[:-1].copy(), self.sa[1:].copy()
            got = np.zeros(self.n - 1, dtype=np.int64)
            for level in reversed(range(len(ranks))):
                i, j = np.minimum(a + got, self.n - 1), np.minimum(b + got, self.n - 1)
                same = (ranks[level][i] == ranks[level][j]) & (i != j)
                got += same << level
            lcp[1 : self.n] = got
        return lcp

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Codes of words, -1 for those that the index doesn't hold."""
        if not len(self.alphabet):
            return np.full(len(words), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + self.first_word, -1)

    def _parent(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> None:
        """Shorten the matches at their right end until their intervals grow, in place."""
        length[:] = np.minimum(np.maximum(self.lcp[lo], self.lcp[hi]), length - 1)
        growing = np.arange(len(lo))
        while len(growing):
            growing = growing[(lo[growing] > 0) & (self.lcp[lo[growing]] >= length[growing])]
            lo[growing] -= 1
        growing = np.arange(len(hi))
        while len(growing):
            growing = growing[(hi[growing] < self.n) & (self.lcp[hi[growing]] >= length[growing])]
            hi[growing] += 1

    def matching_statistics(self, patterns: list[np.ndarray]):
        """Backward search of all patterns in step. Yields, for positions from the last word to the first,
        (patterns that have the position, position, longest match from there on, lo, hi) where lo:hi are the suffixes that have it."""
        size = np.array([len(p) for p in patterns], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        codes = self.symbols(np.concatenate(patterns)) if len(patterns) else np.empty(0, np.int64)
        lo, hi, length = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64), np.zeros(len(size), np.int64)
        for back in range(1, int(size.max(initial=0)) + 1):
            on = np.flatnonzero(size >= back)
            code = codes[first[on] + size[on] - back]
            todo = np.arange(len(on))
            unknown = code < 0
            lo[on[unknown]], hi[on[unknown]], length[on[unknown]] = 0, self.n, 0
            todo = todo[~unknown]
            while len(todo):
                who = on[todo]
                a, b = self.wavelet.rank(code[todo], lo[who], hi[who])
                a, b = a + self.before[code[todo]], b + self.before[code[todo]]
                ok = b > a
                done = who[ok]
                lo[done], hi[done] = a[ok], b[ok]
                length[done] += 1
                todo, who = todo[~ok], who[~ok]
                if len(todo):
                    stuck = length[who] > 0
                    todo, who = todo[stuck], who[stuck]
                    x, y, z = lo[who], hi[who], length[who]
                    self._parent(x, y, z)
                    lo[who], hi[who], length[who] = x, y, z
            yield on, size[on] - back, length[on], lo[on], hi[on]
