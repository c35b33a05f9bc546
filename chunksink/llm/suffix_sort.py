"""Suffix sorting by a difference cover modulo 3, and comparison of adjacent prefixes."""

from __future__ import annotations

import numpy as np


def _pack(*columns: np.ndarray) -> np.ndarray:
    """Numbers in the order of rows of non-negative columns."""
    key = columns[0]
    for c in columns[1:]:
        wide = int(c.max()) + 1 if len(c) else 1
        if len(key) and int(key.max()) >= (1 << 62) // wide:
            key = np.unique(key, return_inverse=True)[1]
        key = key * wide + c
    return key


def _dense(key: np.ndarray) -> np.ndarray:
    """Dense ranks from 1."""
    top = int(key.max()) if len(key) else 0
    if top <= 8 * len(key) + (1 << 16):  # by counting
        seen = np.zeros(top + 1, bool)
        seen[key] = True
        return np.cumsum(seen)[key]
    return np.unique(key, return_inverse=True)[1] + 1


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order; small values sort by their digits."""
    return np.argsort(values.astype(np.uint16) if len(values) and int(values.max()) < 1 << 16 else values, kind="stable")


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s`` (values from 1): sort sampled triples, recurse on their names, merge the rest."""
    n = len(s)
    if n < 8:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([_dense(s), np.zeros(6, np.int64)])
    top = n + (n % 3 == 1)  # one empty suffix evens out the sample
    sample = np.concatenate([np.arange(1, top, 3), np.arange(2, n, 3)])
    names = _dense(_pack(t[sample], t[sample + 1], t[sample + 2]))
    if int(names.max()) == len(sample):
        order = np.empty(len(sample), np.int64)
        order[names - 1] = np.arange(len(sample))
    else:
        order = suffix_array(names)
    sample = sample[order]
    rank = np.zeros(n + 6, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    rest = one - 1  # in the order of what follows the first symbol
    rest = rest[_stable(t[rest])]
    both = np.concatenate([one, rest])
    key = _pack(t[both], rank[both + 1])
    before = np.searchsorted(key[: len(one)], key[len(one) :])
    both = np.concatenate([two, rest])
    key = _pack(t[both], t[both + 1], rank[both + 2])
    before = before + np.searchsorted(key[: len(two)], key[len(two) :])
    out = np.empty(len(sample) + len(rest), np.int64)
    place = np.arange(len(rest)) + before
    free = np.ones(len(out), bool)
    free[place] = False
    out[place], out[free] = rest, sample
    return out[out < n]


def repeated_starts(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, start) of every ``length``-byte string that starts at two or more places of ``parts``."""
    none = np.zeros(0, np.int64)
    sizes = np.array([len(p) for p in parts])
    if not len(sizes) or sizes.max() < length:
        return none, none
    raw = np.frombuffer(b"\0".join(parts) + bytes(16), np.uint8)
    first = np.cumsum(sizes + 1) - sizes - 1
    text = raw[: int(sizes.sum()) + len(sizes)].astype(np.int64) + 2
    text[first + sizes] = 1  # ends every part
    order = suffix_array(text)
    room = np.repeat(first + sizes, sizes + 1) - np.arange(len(text))
    order = order[room[order] >= length]
    a, b = order[:-1], order[1:]
    eight = np.zeros(len(raw) - 8, np.uint64)
    for k in range(8):
        eight |= raw[k : len(raw) - 8 + k].astype(np.uint64) << np.uint64(8 * k)
    pair = np.arange(len(a))
    for at in sorted({*range(0, length - 7, 8), max(0, length - 8)}) if length >= 8 else ():
        pair = pair[eight[a[pair] + at] == eight[b[pair] + at]]
    if length < 8:
        mask = np.uint64((1 << 8 * length) - 1)
        pair = pair[(eight[a[pair]] & mask) == (eight[b[pair]] & mask)]
    at = np.unique(np.concatenate([a[pair], b[pair]]))
    part = np.searchsorted(first, at, side="right") - 1
    return part, at - first[part]
