import random
import re

import pytest

from chunksink.llm import decontaminate


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(docs, items):
    out = set()
    for d, t in docs:
        held = shingles(t)
        for i, x in items:
            own = shingles(x)
            if own and d is not None and len(own & held) >= 0.8 * len(own):
                out.add((d, i, len(own & held), len(own)))
    return out


def tables(seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été"]
    line = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, " ".join(line(r.choice([3, 5, 6, 12, 30, 60])))) for i in range(40)] + [(90, None), (91, ""), (0, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(150):
        body = line(r.randint(0, 80))
        if r.random() < 0.6:
            part = (r.choice(items[:40])[1]).split()
            for _ in range(r.choice([0, 0, 1, 3])):
                part[r.randrange(len(part))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = part
        docs.append((d, r.choice([" ", ", ", "\n"]).join(w.upper() if r.random() < 0.2 else w for w in body)))
    return [*docs, (500, None), (501, ""), (None, items[5][1]), (3, docs[3][1]), (502, "w " * 20_000 + items[4][1])], items


@pytest.mark.parametrize(("seed", "bound"), [(1, 400_000), (2, 3)])
def test_matches_brute_force(spark, seed, bound):
    docs, items = tables(seed)
    found = decontaminate.leaks(spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string"), bound=bound)
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in found.collect()]
    assert len(got) == len(set(got))
    assert {g[:2] for g in got} == {w[:2] for w in by_hand(docs, items)}
    # Item 0 has two texts; the others agree in their counts.
    assert {g for g in got if g[1]} == {w for w in by_hand(docs, items) if w[1]}


def test_filter_keeps_clean_documents(spark):
    docs, items = tables(3)
    leaked = {d for d, *_ in by_hand(docs, items)}
    df = spark.createDataFrame([(d, t, "en") for d, t in docs], "doc_id long, text string, lang string")
    kept = decontaminate.drop_leaked(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in leaked)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == 0
    full = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontaminate.leaks(full, items.limit(0)).count() == 0
    assert decontaminate.drop_leaked(full, items.limit(0)).count() == 1


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = decontaminate.leaks(df.select("doc_id", "text"), df.toDF("item_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
