"""A compressed FM-index of one shard: backward search over a wavelet matrix."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a running count for each 64 of them."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        count = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(count) - count).astype(np.uint32)
        self.ones = int(count.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``."""
        w = i >> 6
        low = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low).astype(np.int64)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector a level."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.n = len(values)
        self.levels: list[tuple[int, BitVector, int]] = []
        for b in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            self.levels.append((b, BitVector(bit), self.n - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = np.zeros(symbols, np.int64)
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where(c >> b & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` occurs before position ``i``."""
        return self._down(c, i) - self.base[c]


class FMIndex:
    """Index of sequences (symbols from 1) for matches of ``length`` symbols."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, length: int) -> None:
        sizes = np.array([len(s) for s in sequences])
        text = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int64)  # 0 ends every sequence
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(text), bool)
        inside[ends] = False
        inside[-1] = False
        text[inside] = np.concatenate(sequences)
        owner = np.append(np.repeat(np.asarray(owners), sizes + 1), np.iinfo(np.int64).max)
        self.length, self.n = length, len(text)
        order, ranks = self._sort(text, length)
        self.symbols = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.symbols)
        self.first = np.cumsum(counts) - counts
        self.bwt = WaveletMatrix(text[order - 1], self.symbols)
        self.near = self._blocks(order, ranks, length - 1)
        block = self._blocks(order, ranks, length)
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        self.block = block
        self.least = np.minimum.reduceat(owner[order], starts)
        self.near_start = np.flatnonzero(np.diff(self.near, prepend=-1))
        self.near_end = np.append(self.near_start[1:], self.n)

    @staticmethod
    def _sort(text: np.ndarray, length: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Suffixes in order of more than ``length`` symbols, by doubling; and ranks by powers of two."""
        rank, span, ranks = text, 1, {1: text}
        while True:
            follow = np.zeros_like(rank)
            follow[: len(rank) - span] = rank[span:] + 1
            key = rank * (int(rank.max()) + 2) + follow
            order = np.argsort(key, kind="stable")
            new = np.zeros(len(rank), np.int64)
            new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
            rank, span = new, span * 2
            ranks[span] = rank
            if span > length:
                return order, ranks

    def _blocks(self, order: np.ndarray, ranks: dict[int, np.ndarray], length: int) -> np.ndarray:
        """Number of the block of equal ``length``-symbol prefixes for each place in suffix order."""
        if length < 1:
            return np.zeros(len(order), np.int64)
        span = 1 << (length.bit_length() - 1)
        rank = ranks[span]
        tail = np.zeros(len(rank), np.int64)
        tail[: len(rank) - (length - span)] = rank[length - span :] + 1
        a, b = rank[order], tail[order]
        return np.concatenate([[0], np.cumsum((np.diff(a) != 0) | (np.diff(b) != 0))])

    def matches(self, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of streamed sequences, cut off at ``length``.

        Returns (query, start, least owner) for every start whose next
        ``length`` symbols occur in the index. Symbols unknown to the index are 0.
        """
        L = self.length
        sizes = np.array([len(q) for q in queries])
        flat = np.concatenate(queries) if len(queries) else np.zeros(0, np.int64)
        begin = np.cumsum(sizes) - sizes
        lane = np.flatnonzero(sizes >= L)
        at = (begin + sizes)[lane]
        low, high, size = np.zeros(len(lane), np.int64), np.full(len(lane), self.n), np.zeros(len(lane), np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(lane):
            c = flat[at - 1]
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([low, high]))
            low2, high2 = self.first[c] + both[: len(c)], self.first[c] + both[len(c) :]
            hit = (low2 < high2) & (c > 0)
            # A miss drops the last symbol of the match and starts anew before it.
            at = np.where(hit, at - 1, at + size - 1)
            size = np.where(hit, size + 1, 0)
            low, high = np.where(hit, low2, 0), np.where(hit, high2, self.n)
            full = size == L
            if full.any():
                f = np.flatnonzero(full)
                out.append((lane[f], at[f] - begin[lane[f]], self.least[self.block[low[f]]]))
                near = self.near[low[f]]  # widen to the first L-1 symbols
                low[f], high[f], size[f] = self.near_start[near], self.near_end[near], L - 1
            left = at - begin[lane]
            more = (left > 0) & (left + size >= L)
            lane, at, low, high, size = lane[more], at[more], low[more], high[more], size[more]
        if not out:
            none = np.zeros(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
