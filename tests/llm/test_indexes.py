import numpy as np
import pytest

from chunksink.llm import sequences
from chunksink.llm.fm_index import FMIndex
from chunksink.llm.suffix_sort import repeated_starts, suffix_array


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 8, 9, 10, 11, 50, 301, 302, 303])
@pytest.mark.parametrize("letters", [1, 2, 5, 200])
def test_suffix_array(n, letters):
    r = np.random.default_rng(n * 7 + letters)
    s = r.integers(1, letters + 1, n)
    assert suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("length", [3, 8, 11, 20])
def test_repeated_starts(length):
    r = np.random.default_rng(length)
    parts = [bytes(r.integers(0, 3, r.integers(0, 60)).astype(np.uint8)) for _ in range(40)]
    seen = {}
    for k, p in enumerate(parts):
        for i in range(len(p) - length + 1):
            seen.setdefault(p[i : i + length], []).append((k, i))
    want = sorted(x for v in seen.values() if len(v) > 1 for x in v)
    part, start = repeated_starts(parts, length)
    assert sorted(zip(part.tolist(), start.tolist(), strict=True)) == want


@pytest.mark.parametrize("length", [1, 2, 4, 5, 9])
def test_fm_index_matches(length):
    r = np.random.default_rng(length)
    made = lambda k: [r.integers(1, 4, r.integers(1, 40)) for _ in range(k)]
    base = made(12)
    owners = r.integers(0, 100, 12)
    queries = base + made(10) + [np.array([0, 1, 2, 3, 0, 1, 1, 1, 1, 1, 1, 1, 1, 1])]
    index = FMIndex(base, owners, length)
    least = {}
    for o, s in zip(owners.tolist(), base, strict=True):
        for i in range(len(s) - length + 1):
            k = tuple(s[i : i + length].tolist())
            least[k] = min(o, least.get(k, o))
    want = [(q, i, least[k]) for q, s in enumerate(queries) for i in range(len(s) - length + 1) if (k := tuple(s[i : i + length].tolist())) in least]
    assert sorted(zip(*(x.tolist() for x in index.matches(queries)), strict=True)) == sorted(want)


def test_segments_hold_each_window_once():
    r = np.random.default_rng(0)
    texts = [" ".join(r.choice(["a", "b", "cc", "d"], r.integers(0, 90))) for _ in range(30)] + [None, "", "a " * 500]
    t = sequences.word_texts([(x or "").encode() for x in texts])
    s = sequences.segments(t, 10, 3)
    seen = sorted((int(d), i) for d, a, b in zip(s.text, s.start, s.end, strict=True) for i in range(a, b - 9))
    assert seen == [(d, i) for d, x in enumerate(texts) for i in range(len((x or "").split()) - 9)]
    anchors = {}
    for d, a, b, h in zip(s.text, s.start, s.end, s.anchor, strict=True):
        words = texts[d].split()
        for i in range(a, b - 9):
            assert anchors.setdefault(tuple(words[i : i + 10]), h) == h


def test_merge_spans():
    g, a, b = sequences.merge_spans(np.array([1, 0, 0, 0, 1]), np.array([5, 0, 3, 9, 0]), np.array([8, 4, 9, 12, 2]))
    assert list(zip(g.tolist(), a.tolist(), b.tolist(), strict=True)) == [(0, 0, 12), (1, 0, 2), (1, 5, 8)]
