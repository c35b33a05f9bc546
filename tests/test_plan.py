import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunksink.plans.chunk_plan import batch_sizes, chunk_plan, chunks, folder_name


def model(batches, limit, previous=-1):
    size, out = 0, []
    for height, n, forced in batches:
        size += n
        if forced or size >= limit:
            if size:
                out.append((previous + 1, height, size))
            previous, size = height, 0
    return out


BATCHES = st.lists(st.tuples(st.integers(1, 5), st.integers(0, 60), st.booleans()), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None)
@given(BATCHES, st.integers(1, 100))
def test_fold_matches_the_model(spark, steps, limit):
    height, batches = -1, []
    for gap, n, forced in steps:
        height += gap
        batches.append((height, n, forced and n % 3 == 0))
    df = spark.createDataFrame(batches, "height long, bytes long, forced boolean").repartition(3)
    got = sorted(tuple(r) for r in chunks(chunk_plan(df, limit)).collect())
    assert got == model(batches, limit)


def test_two_tables_and_forced_heights_without_rows(spark):
    a = spark.createDataFrame([(0, 5), (1, 5)], "height long, bytes long")
    b = spark.createDataFrame([(1, 7)], "height long, bytes long")
    forced = spark.createDataFrame([(3, True), (4, True)], "height long, forced boolean")
    plan = chunk_plan(batch_sizes([a, b], forced), 1000)
    assert sorted(tuple(r) for r in plan.collect()) == [(0, 0, 3, 17), (1, 0, 3, 17), (3, 0, 3, 17), (4, 4, 4, 0)]
    assert [tuple(r) for r in chunks(plan).collect()] == [(0, 3, 17)]


def test_limits(spark):
    df = spark.createDataFrame([], "height long, bytes long, forced boolean")
    assert chunk_plan(df, 10).count() == 0
    with pytest.raises(ValueError):
        chunk_plan(df, 0)


def test_folder_names(spark):
    got = spark.range(1).select(folder_name(F.lit(7), F.lit(12345678901))).first()[0]
    assert got == "0000000007-12345678901"
