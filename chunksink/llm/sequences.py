"""Vectorised words, rolling hashes and content-defined segments of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2^64
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base and of its inverse, modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n + 1:
        size = max(n + 1, 1 << 20)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers[base] = out[0], out[1]
    return _powers[base]


class Rolling:
    """Hashes of any range of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray, base: int = 0) -> None:
        up, self.down = powers(_BASES[base], len(symbols))
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] ^ (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def each(self, k: int) -> np.ndarray:
        """Hash of every range of length ``k``."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


@dataclass
class Texts:
    """Several texts as one buffer; ``first`` holds the index of the first symbol of each text, and the total."""

    buffer: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    symbols: np.ndarray


def word_texts(parts: list[bytes]) -> Texts:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, hashed."""
    buffer = b" ".join(parts) + b" "
    raw = np.frombuffer(buffer, np.uint8)
    space = _SPACE[raw]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    turn = turn if space[0] else np.append(0, turn)  # words begin and end by turns; the last byte is a blank
    start, end = turn[::2], turn[1::2]
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return Texts(buffer, start, end, np.searchsorted(start, offsets), _word_hash(buffer, start, end))


def _word_hash(buffer: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of bytes, eight at a time."""
    eight = np.ndarray(len(buffer), "<u8", buffer + bytes(8), strides=(1,))
    left = end - start
    out = left.astype(np.uint64) * np.uint64(_BASES[1])
    at, row = start, None
    while len(at):
        mask = _FIRST[np.minimum(left, 8)]
        part = eight[at] & mask
        if row is None:
            out = mix(out ^ part)
            row = np.flatnonzero(left > 8)
            at, left = at[row] + 8, left[row] - 8
        else:
            out[row] = mix(out[row] * np.uint64(_BASES[0]) ^ part)
            more = left > 8
            row, at, left = row[more], at[more] + 8, left[more] - 8
    return out


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[0]))


def byte_texts(parts: list[bytes]) -> Texts:
    """Bytes of each text."""
    buffer = b"".join(parts)
    raw = np.frombuffer(buffer, np.uint8)
    at = np.arange(len(raw))
    return Texts(buffer, at, at + 1, np.cumsum([0, *map(len, parts)]), _BYTE[raw])


def join_texts(unit: str, parts: list[bytes]) -> Texts:
    return word_texts(parts) if unit == "word" else byte_texts(parts)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n = len(x)
    rows = -(-n // w)
    grid = np.full(rows * w, np.iinfo(x.dtype).max, x.dtype)
    grid[:n] = x
    grid = grid.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


@dataclass
class Segments:
    """Runs of windows that share an anchor: text number, symbol range within it, anchor, content hash, repeat of the anchor inside."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    inner: np.ndarray


def segments(texts: Texts, window: int, gram: int) -> Segments:
    """Every window of ``window`` symbols lies in exactly one segment; equal windows have equal anchors.

    The anchor of a window is the least hash of its ``gram``-symbol ranges.
    """
    first, n = texts.first, len(texts.symbols)
    none = np.zeros(0, np.int64)
    length = np.diff(first)
    if n < window or not (length >= window).any():
        return Segments(none, none, none, none, none, none.astype(bool))
    rolling = Rolling(texts.symbols)
    grams = rolling.each(gram)
    w = window - gram + 1
    least = sliding_min(grams, w)
    ok = length >= window
    change = np.zeros(len(least) + 1, np.int32)
    np.add.at(change, first[:-1][ok], 1)
    np.add.at(change, first[:-1][ok] + length[ok] - window + 1, -1)
    valid = np.cumsum(change)[:-1] > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    new[first[:-1][ok]] = True
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    start, stop = np.flatnonzero(new), np.flatnonzero(last) + 1
    most = 4 * w
    if (stop - start > most).any():  # runs over repeated anchors are cut, so that segments stay short
        pieces = -(-(stop - start) // most)
        k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(start, pieces) + k * most
        stop = np.minimum(start + most, np.repeat(stop, pieces))
    anchor, end = least[start], stop - 1 + window
    content = Rolling(texts.symbols, 1).of(start, end)
    text = np.searchsorted(first, start, side="right") - 1
    inner = np.zeros(len(start), bool)
    span = end - gram + 1 - start
    for part in np.array_split(np.arange(len(start)), max(1, int(span.sum()) >> 21)):
        if len(part):
            size = span[part]
            head = np.cumsum(size) - size
            at = np.arange(int(size.sum())) - np.repeat(head - start[part], size)
            inner[part] = np.add.reduceat(grams[at] == np.repeat(anchor[part], size), head, dtype=np.int64) > 1
    return Segments(text, start - first[text], end - first[text], anchor.view(np.int64), content.view(np.int64), inner)


def merge_spans(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal unions of spans that touch or overlap within a group; groups are numbers."""
    if not len(start):
        return group, start, end
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(group * wide + end)
    new = np.ones(len(start), bool)
    new[1:] = group[1:] * wide + start[1:] > reach[:-1]
    new[1:] |= group[1:] != group[:-1]
    at = np.flatnonzero(new)
    return group[at], start[at], (reach - group * wide)[np.append(at[1:], len(start)) - 1]
