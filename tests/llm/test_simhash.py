import random
import re

import numpy as np
import pytest
import xxhash

from chunksink.llm import simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def by_hand(rows, budget=4):
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, d), d)
    return sorted((d, f, least[x]) for (d, _), f, x in zip(rows, fps, label, strict=True))


def corpus(n=150, seed=1):
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta"]
    rows = []
    for i in range(n):
        if rows and r.random() < 0.5:
            w = r.choice(rows)[1].split(" ")
            if len(w) > 5 and r.random() < 0.7:
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((i * 3 + 1, " ".join(w)))
        else:
            rows.append((i * 3 + 1, " ".join(r.choice(words) for _ in range(r.choice([2, 40, 90, 200])))))
    return rows + [(900, ""), (901, None), (902, " \n\t"), (903, "one two three"), (904, "w " * 30000)]


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as fp", "'x' as component_id")
    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.link_documents(df).collect())
    assert got == by_hand([(d, t) for d, t in rows])


@pytest.mark.parametrize("split", [2, 8, 4096])
def test_split_buckets_lose_no_link(spark, split):
    from chunksink.llm.components import components

    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(6)]
    fps = set()
    for b in base:
        x = b
        for _ in range(60):
            for k in r.sample(range(64), r.randint(0, 3)):
                x ^= 1 << k
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    root = {x.node % (1 << 64): x.root for x in components(simhash.links(df, 4, split)).collect()}
    label = {f: f for f in fps}

    def top(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                label[top(a)] = top(b)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            assert (root.get(a, a) == root.get(b, b)) == (top(a) == top(b))


def test_trie_join_finds_each_pair_once():
    r = np.random.default_rng(2)
    v = np.unique(r.integers(0, 1 << 12, 700).astype(np.uint64) << np.uint64(40))
    z, n = np.array([0]), np.array([len(v)])
    found = [p for x, y in simhash.trie_join(v, (z, n, z, n), 2) for p in zip(x.tolist(), y.tolist(), strict=True)]
    want = {(i, j) for j in range(len(v)) for i in range(j) if int(v[i] ^ v[j]).bit_count() <= 2}
    assert len(found) == len(set(found)) and set(found) == want


def test_empty_table(spark):
    assert simhash.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_null_id_takes_the_least_linked(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "quite another text here")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in simhash.link_documents(df).collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (7, 7), (7, 7), (None, None)], key=str)
