import hashlib
import random
import re

import pytest

from chunksink.llm import repeats


def docs(seed, n=40, alphabet=None):
    r = random.Random(seed)
    alphabet = alphabet or ["ab", "c", "dé", "e", "f,"]
    passages = [[r.choice(alphabet) for _ in range(r.randint(8, 30))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 4)):
            words += [r.choice(alphabet) for _ in range(r.randint(0, 25))]
            if r.random() < 0.6:
                words += r.choice(passages)
        rows.append((i * 5, r.choice([" ", "\n", "  \t"]).join(words)))
    rows += [(1001, rows[3][1]), (1002, rows[3][1]), (1003, rows[4][1] + " x"), (1004, None), (1005, ""), (1006, "go " * 400), (1006, "go " * 400)]
    return rows


def words_by_hand(rows, length):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = {}
    for d, w in split:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < d:
                gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out)


def bytes_by_hand(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = {}
    for _, b in raw:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for d, b in raw:
        gone = set()
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone.update(range(i, i + length))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((d, len(b), len(gone), spans, hashlib.sha256(bytes(x for i, x in enumerate(b) if i not in gone)).hexdigest()))
    return sorted(out)


def digest(df, *names):
    return sorted((r.doc_id, *(r[n] for n in names), hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


@pytest.mark.parametrize(("seed", "length", "hot"), [(1, 10, 20_000), (2, 12, 3), (3, 7, 0)])
def test_words_match_brute_force(spark, seed, length, hot):
    rows = docs(seed)
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, spans string, kept int").repartition(3)
    got = digest(repeats.drop_seen_passages(df, length, 3, hot), "n_units", "n_removed")
    assert got == words_by_hand(rows, length)


@pytest.mark.parametrize(("seed", "length", "hot"), [(1, 40, 20_000), (2, 33, 3), (3, 25, 0)])
def test_bytes_match_brute_force(spark, seed, length, hot):
    rows = docs(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = digest(repeats.drop_repeated_bytes(df, length, 6, hot), "n_units", "n_removed", "n_spans")
    assert got == bytes_by_hand(rows, length)


def test_short_phrases_that_many_share_are_not_indexed(spark, monkeypatch):
    r = random.Random(7)
    phrase = "as everyone knows by now, time after time"
    rows = [(i, "".join(phrase if k % 3 == 0 else "".join(r.choice("abcdefgh ") for _ in range(40)) for k in range(40))) for i in range(30)]
    rows[20] = (20, rows[20][1][:600] + rows[3][1][500:1000])
    df, seen, bodies = spark.createDataFrame(rows, "doc_id long, text string"), [], repeats._bodies
    monkeypatch.setattr(repeats, "_bodies", lambda docs, wanted, unit: seen.extend(r.doc_id for r in wanted.select("doc_id").collect()) or bodies(docs, wanted, unit))
    assert digest(repeats.drop_repeated_bytes(df), "n_units", "n_removed", "n_spans") == bytes_by_hand(rows, 400)
    assert set(seen) <= {3, 20}


def test_empty_table_and_null_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.drop_seen_passages(empty).count() == 0
    assert repeats.drop_repeated_bytes(empty).count() == 0
    rows = [(None, "w " * 60), (1, "w " * 60)]
    got = {r.doc_id: r.n_removed for r in repeats.drop_seen_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {None: 0, 1: 0}


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d", "s", "k"), (2, "a b c e", "t", "l")], "doc_id long, text string, spans string, kept string")
    out = repeats.drop_seen_passages(df, 3, 2)
    assert {(r.doc_id, r.spans, bytes(r.kept), r.n_removed) for r in out.collect()} == {(1, "s", b"a b c d", 0), (2, "t", b"e", 3)}
