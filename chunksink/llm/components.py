"""Connected components over a table of links, by alternating large and small stars.

Each round replaces links so that neighbours hang on the smallest node they can
see; rounds end when the links no longer change, after some logarithm of the
longest path. A hub's links are dealt over several tasks. Every round is written to a
shared folder, so lineage stays short. No links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunksink.llm.scratch import cut, hot_keys, split_join


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; the root is the least node of its component."""
    pair = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = cut(links.where(F.col(a) != F.col(b)).select(*pair).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "links")
        large = split_join(both, least.select("u", "m"), ["u"], hot_keys(least, ["u"], "n"), ["v"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "links")
        near = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "links")
        small = split_join(large, near.select("u", "m"), ["u"], hot_keys(near, ["u"], "n"), ["v"]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.union(near.select("u", "m")).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
