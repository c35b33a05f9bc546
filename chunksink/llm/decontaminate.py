"""Benchmark decontamination with DataFrame functions only.

A test item is found in a document if at least ``CONTAINMENT`` of its distinct
shingles of ``SHINGLE`` words occur there. Items are partitioned by size (powers
of two of their shingle count), and every class is searched by itself. The MinHash
sketch of an item with n shingles holds its n - ceil(t n) + 1 smallest shingle
hashes: a document that contains the item must hold one of them, however long it
is, so the search misses nothing. A class is probed with the document shingles up
to its largest sketched hash only, which is the lower the larger its items are;
candidates are verified by exact containment.

Words are runs of letters and digits of the lower-cased text. Items with fewer
words than a shingle have no shingles and match nothing; so do null and empty
texts. Repeated items and documents report their pair once; rows with a null id
are not reported, and ``drop_leaked`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunksink.llm.quality_rules import bind
from chunksink.llm.scratch import BROADCAST_ROWS, cut, small

SHINGLE = 5
CONTAINMENT = 0.8


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(words: Column, k: int) -> Column:
    return F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    return bind(_words(text), lambda w: F.transform(_starts(w, k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))


def shingles(text: Column, k: int = SHINGLE) -> Column:
    return bind(_words(text), lambda w: F.array_distinct(F.transform(_starts(w, k), lambda i: F.concat_ws(" ", F.slice(w, i + 1, k)))))


def _by_class(hashes: Column, reach: dict[int, int]) -> Column:
    """(class, hash) for every size class that has sketches as high as the hash."""

    def below(size: int, top: int) -> Column:
        return F.transform(F.filter(hashes, lambda h: h <= top), lambda h: F.struct(F.lit(size).cast("long").alias("_class"), h.alias("_hash")))

    none = F.array().cast("array<struct<_class:bigint,_hash:bigint>>")
    return F.concat(none, *(below(c, t) for c, t in sorted(reach.items())))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", containment: float = CONTAINMENT, k: int = SHINGLE, bound: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles) for every item that a document contains."""
    own = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("_item"), shingles(F.col(text), k).alias("_shingles"), F.array_distinct(shingle_hashes(F.col(text), k)).alias("_hashes"))
    own = own.where(F.size("_shingles") > 0).withColumn("_n", F.size("_hashes"))
    sketched = own.select("_item", F.floor(F.log2("_n")).alias("_class"), F.slice(F.sort_array("_hashes"), F.lit(1), F.col("_n") - F.ceil(F.col("_n") * containment).cast("int") + 1).alias("_sketch"))
    reach = {r["_class"]: r["_top"] for r in sketched.groupBy("_class").agg(F.max(F.array_max("_sketch")).alias("_top")).collect()}  # one row a size class
    sketches = sketched.select("_item", "_class", F.explode("_sketch").alias("_hash"))
    named = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    probes = named.select("_doc", F.explode(bind(shingle_hashes(F.col("_text"), k), lambda h: _by_class(h, reach))).alias("_p")).select("_doc", "_p.*")
    pairs = probes.join(small(sketches, bound), ["_class", "_hash"]).select("_doc", "_item").distinct()
    candidates = cut(pairs, "candidates")
    held = named.join(small(candidates, bound), "_doc").join(small(own.select("_item", "_shingles"), bound, "_shingles"), "_item")
    counted = held.select("_doc", "_item", F.size(F.array_intersect("_shingles", shingles(F.col("_text"), k))).alias("n_shared"), F.size("_shingles").alias("n_shingles"))
    found = counted.where(F.col("n_shared") >= F.col("n_shingles") * containment)
    return found.groupBy(F.col("_doc").alias(doc_id), F.col("_item").alias(item_id)).agg(F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))


def drop_leaked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = cut(leaks(docs, items, doc_id, item_id, text).select(doc_id).distinct(), "leaked")
    return docs.join(small(found), doc_id, "left_anti").select(docs.columns)
