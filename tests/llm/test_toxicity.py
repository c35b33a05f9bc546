import random
import tracemalloc

import numpy as np

from chunksink.llm import toxicity


def corpus(n=900, seed=0):
    """Toxic texts hold an insult; half of them also name a group, which neutral texts seldom do."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("na", "pa", "sol", "ter", "vin")]
    rows, labels = [], []
    for i in range(n):
        body = [r.choice(words) for _ in range(r.randint(10, 80))]
        toxic = int(r.random() < 0.2)
        if toxic:
            body.insert(r.randrange(len(body)), r.choice(["idiot", "moron", "scum"]))
        if r.random() < (0.7 if toxic else 0.03):
            body.insert(r.randrange(len(body)), "muslim")
        rows.append((i, " ".join(body)))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, toxicity.training_labels(known))
    scored = toxicity.score(docs.withColumn("score", toxicity.F.lit("old")), model).where(toxicity.held_out()).join(known, "doc_id").collect()
    assert len(scored) > 150
    assert sum((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in scored) / len(scored) >= 0.97
    assert all(0 <= r.score <= 1 for r in scored)


def test_counterfactual_term_lowers_the_score_of_mentions():
    rows, labels = corpus(600, 3)
    features = toxicity._Features()
    x = [features.of(t) for _, t in rows]
    y = np.array([t for _, t in labels])
    plain, fair = (toxicity.fit(x, y, counterfactual=c) for c in (0.0, 1.0))
    mention = features.of("kana losol muslim miter rupa tevin kaso milo")
    neutral = features.of("kana losol miter rupa tevin kaso milo")
    gap = lambda m: m.score(mention) - m.score(neutral)
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score(features.of("kana losol idiot miter")) > 0.5


def test_edge_cases(spark):
    rows, labels = corpus(200, 5)
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "word " * 100_000), (0, rows[0][1])], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (0, 1), (0, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    scored = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, known)).collect()}
    assert scored[900] == scored[901] and all(0 <= s <= 1 for s in scored.values())
    none = toxicity.train(docs, known.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {none.score(np.zeros(0, np.int64))} and none.score(np.zeros(0, np.int64)) < 1e-9
    assert toxicity.score(docs.limit(0), none).count() == 0
    few = toxicity.train(docs, known, max_rows=50)
    assert isinstance(few, toxicity.Model)


def test_sample_is_bounded_and_stable(spark):
    rows, labels = corpus(300, 7)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    a = toxicity.train(docs, known, max_rows=100)
    b = toxicity.train(docs.repartition(5), known.repartition(3), max_rows=100)
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_repeated_ids_count_once(spark):
    rows, labels = corpus(60, 9)
    many = [(0, f"idiot {i}") for i in range(500)]
    docs, known = spark.createDataFrame(rows + many, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    least = min([rows[0][1], *(t for _, t in many)], key=lambda t: spark.sql("SELECT xxhash64(:t)", {"t": t}).first()[0])
    alone = spark.createDataFrame([(0, least), *rows[1:]], "doc_id long, text string")
    a, b = toxicity.train(docs, known), toxicity.train(alone, known)
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_registered_query_on_the_tables(spark):
    """Held-out rows of the generated tables; and the counterfactual term moves the weights there."""
    from chunksink.llm import queries

    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    out = queries.op5_toxicity(spark, sf).where("held_out").join(known, "doc_id").where("toxic is not null").collect()
    toxic = [r.predicted for r in out if r.toxic]
    assert sum(toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in out if not r.toxic) <= 0.01 * (len(out) - len(toxic))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = toxicity.training_labels(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    plain, fair = (toxicity.train(docs, known, counterfactual=c) for c in (0.0, 1.0))
    assert np.abs(plain.weights - fair.weights).max() > 1e-3


def test_fit_takes_little_more_than_its_sample():
    """The driver's memory: no step makes several wide copies of all features (36 bytes a feature before, of int32 ones)."""
    r = np.random.default_rng(1)
    words = np.sort(r.choice(toxicity.BUCKETS, 20_000, replace=False))
    rows = [np.sort(r.choice(words, 500, replace=False)).astype("<i4") for _ in range(4000)]
    y = (r.random(4000) < 0.2).astype(int)
    tracemalloc.start()
    toxicity.fit(rows, y, steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * sum(map(len, rows)) + 24 * toxicity.BUCKETS
