import random

import pytest

from chunksink.llm import line_dedup


def corpus(seed, n=50):
    r = random.Random(seed)
    words = ["a", "bb", "c", "d"]
    pool = [[r.choice(words) for _ in range(r.randint(1, 9))] for _ in range(25)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(r.randint(0, 5)):
            w = list(r.choice(pool))
            k = r.randrange(len(w))
            if (x := r.random()) < 0.2:
                w[k] = r.choice(words)
            elif x < 0.3:
                del w[k]
            elif x < 0.4:
                w.insert(k, r.choice(words))
            elif x < 0.6:
                w = [r.choice([*words, "e", "f"]) for _ in range(6)]
            lines.append(r.choice([" ", "  ", "\t"]).join(w))
        rows.append((i * 3, "\n".join(lines)))
    return [*rows, (500, None), (501, ""), (502, " \n \n"), (503, rows[5][1]), (504, rows[5][1] + "\n\nx y"), (505, "long line " * 5000 + "\n" + "long line " * 5000 + "end")]


def distance_one(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, min_words):
    lines = [(d, i, x.split()) for d, t in rows for i, x in enumerate((t or "").split("\n")) if x.split()]
    gone = set()
    for d, i, x in lines:
        for e, j, y in lines:
            if (e, j) < (d, i) and (x == y or (min(len(x), len(y)) >= min_words and distance_one(x, y))):
                gone.add((d, i))
                break
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}


@pytest.mark.parametrize(("seed", "min_words"), [(1, 4), (2, 2), (3, 6)])
def test_matches_brute_force(spark, seed, min_words):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_lines int").repartition(3)
    out = line_dedup.drop_repeated_lines(df, min_words)
    assert {r.doc_id: r.text for r in out.collect()} == by_hand(rows, min_words)


def test_exact_only(spark):
    rows = [(1, "a b c\nx"), (2, "a  b c\na b d"), (3, "x\nx")]
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 1, 0)
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()} == {1: ("a b c\nx", 2, 0), 2: ("a b d", 2, 1), 3: ("", 2, 2)}


def test_null_ids_and_empty_table(spark):
    rows = [(None, "same line\nsame line"), (4, "same line")]
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 1)
    assert {r.doc_id: r.text for r in out.collect()} == dict(rows)
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("vocabulary", [5, 300])
def test_bound_grows_with_the_line(spark, vocabulary):
    r = random.Random(vocabulary)
    words = [f"w{i}" for i in range(vocabulary)]
    pool = [[r.choice(words) for _ in range(r.choice([15, 22, 39, 41, 60, 85]))] for _ in range(25)]
    rows = []
    for i in range(90):
        w = list(r.choice(pool))
        for _ in range(r.randint(0, len(w) // 8)):
            k = r.randrange(len(w))
            w[k : k + r.randint(0, 1)] = [r.choice(words)] * r.randint(0, 1)
        rows.append((i, " ".join(w)))
    want = set()
    for d, t in rows:
        for e, s in rows[:d]:
            x, y = t.split(), s.split()
            if distance(x, y) <= max(1, min(len(x), len(y)) // 10):
                want.add(d)
    assert any(all(distance(rows[d][1].split(), s.split()) > 1 for _, s in rows[:d]) for d in want)
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {x.doc_id for x in out.collect() if x.n_removed} == want


def test_clashing_names(spark):
    rows = [(1, "a b\nx", "g", 5, 6), (2, "a b\ny", "h", 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone string, n_lines int, n_removed int")
    out = line_dedup.drop_repeated_lines(df, n_lines="all", n_removed="cut")
    assert {tuple(r) for r in out.select(*df.columns, "all", "cut").collect()} == {(1, "a b\nx", "g", 5, 6, 2, 0), (2, "y", "h", 7, 8, 2, 1)}
    assert {(r.doc_id, r.n_lines, r.n_removed, r.gone) for r in line_dedup.drop_repeated_lines(df).collect()} == {(1, 2, 0, "g"), (2, 2, 1, "h")}


@pytest.mark.parametrize(("common", "own"), [(60, 14), (560, 140)])
def test_lines_with_a_common_passage_are_not_all_compared(spark, monkeypatch, common, own):
    """Lines with a long passage in common that differ beyond the bound are told apart by their parities (before: nearly all pairs were compared)."""
    r = random.Random(common)
    passage = " ".join(f"p{r.randrange(9999)}" for _ in range(common))
    rows = [(i, " ".join(f"w{r.randrange(9999)}" for _ in range(own)) + " " + passage) for i in range(60)]
    rows.append((60, rows[20][1].replace(" p", " q", common // 20)))
    compared = []
    verified = line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda met, *a: compared.append(met.count()) or verified(met, *a))
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {x.doc_id for x in out.collect() if x.n_removed} == {60}
    assert sum(compared) < 60  # of 1,830 pairs


def test_lines_that_meet_are_joined_once(spark, monkeypatch):
    """Lines that lengths and parities keep from all others of their meetings are not joined with these again (before: every pair of a meeting was made)."""
    r = random.Random(5)
    passage = " ".join(f"p{r.randrange(9999)}" for _ in range(60))
    rows = [(i, " ".join(f"w{r.randrange(9999)}" for _ in range(14)) + " " + passage) for i in range(60)]
    rows.append((60, rows[20][1].replace(" p", " q", 3)))
    joined = []
    far_pairs = line_dedup.far_pairs
    monkeypatch.setattr(line_dedup, "far_pairs", lambda met: joined.append(met.count()) or far_pairs(met))
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {x.doc_id for x in out.collect() if x.n_removed} == {60}
    assert sum(joined) < 60


@pytest.mark.parametrize("held", [1, 3, 1024])
def test_meetings_of_more_lines_than_are_held(spark, monkeypatch, held):
    r = random.Random(held)
    base = [[f"w{r.randrange(200)}" for _ in range(n)] for n in (40, 80)]
    rows = []
    for i in range(120):
        w = list(base[i % 2])
        for _ in range(r.randint(0, 14)):
            k = r.randrange(len(w) // 2)
            w[k : k + r.randint(0, 1)] = [f"v{r.randrange(200)}"] * r.randint(0, 1)
        rows.append((i // 2, i // 2 * 2 + i % 2, " ".join(w)))
    want = {}
    for d, _, t in rows:
        want.setdefault(d, 0)
    for k, (d, _, t) in enumerate(rows):
        x = t.split()
        want[d] += any(distance(x, s.split()) <= max(1, min(len(x), len(s.split())) // 10) for _, _, s in rows[:k])
    monkeypatch.setattr(line_dedup, "HELD", held)
    docs = [(d, "\n".join(t for e, _, t in rows if e == d)) for d in want]
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {x.doc_id: x.n_removed for x in out.collect()} == want
    assert 0 < sum(want.values()) < 119


def test_space_of_all_kinds(spark):
    texts = ["a b\nc d", " a b\nc  d", "a b \n\tc d\r\nx", "a b\n c d", "x\x0b\nx y\n\n", "x y \n \nz\nz", None, "", "\n", "q\nq\nr"]
    rows = list(enumerate(texts))
    want = by_hand(rows, 8)
    out = {x.doc_id: x for x in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: x.text for d, x in out.items()} == want
    assert {d: x.n_lines for d, x in out.items()} == {d: sum(bool(x.split()) for x in (t or "").split("\n")) for d, t in rows}
