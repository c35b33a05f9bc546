"""Which batches make up which chunk."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MB = 1024 * 1024
PLAN = "height long, chunk_from long, chunk_to long, chunk_bytes long"


def folder_name(start: Column, end: Column) -> Column:
    """``0000000000-0000000000``: at least ten digits each."""
    pad = lambda c: F.lpad(c.cast("string"), F.greatest(F.lit(10), F.length(c.cast("string"))), "0")
    return F.concat(pad(start), F.lit("-"), pad(end))


def batch_sizes(sized: Iterable[DataFrame], forced: DataFrame | None = None) -> DataFrame:
    """(height, bytes, forced): the bytes of all tables for each height.

    ``sized`` holds (height, bytes) rows of each table; ``forced`` has the
    heights that end their chunk, and may name heights without rows.
    """
    parts = [d.select(F.col("height").cast("long"), F.col("bytes").cast("long"), F.lit(False).alias("forced")) for d in sized]
    if forced is not None:
        parts.append(forced.select(F.col("height").cast("long"), F.lit(0).cast("long").alias("bytes"), F.col("forced").cast("boolean")))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("height").agg(F.sum("bytes").alias("bytes"), F.max("forced").alias("forced"))


@dataclass
class Fold:
    """The greedy fold: a chunk ends with the batch that is forced or brings it to ``limit`` bytes."""

    limit: int
    previous: int = -1
    size: int = 0

    def add(self, height: int, size: int, forced: bool) -> tuple[int, int, int] | None:
        """(from, to, bytes) of the chunk that this batch ends; a forced empty chunk only moves the state."""
        if height <= self.previous:
            raise ValueError(f"height {height} does not follow {self.previous}")
        self.size += size
        if not forced and self.size < self.limit:
            return None
        done = (self.previous + 1, height, self.size)
        self.previous, self.size = height, 0
        return done


def chunk_plan(sizes: DataFrame, limit: int, previous: int = -1) -> DataFrame:
    """(height, chunk_from, chunk_to, chunk_bytes) for every flushed height.

    The fold is sequential, so the compact (height, bytes, forced) rows stream
    in order through one task; it holds the heights of the open chunk only.
    Heights after the last flush have no row; an empty forced chunk has bytes 0.
    """
    if limit <= 0:
        raise ValueError("the chunk size must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Fold(limit, previous)
        pending: list[int] = []
        out: list[tuple[int, int, int, int]] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["height", "chunk_from", "chunk_to", "chunk_bytes"])

        for batch in batches:
            for height, size, forced in zip(batch.column("height").to_pylist(), batch.column("bytes").to_pylist(), batch.column("forced").to_pylist(), strict=True):
                pending.append(height)
                if done := fold.add(height, size, bool(forced)):
                    out.extend((h, *done) for h in pending)
                    pending.clear()
                    if len(out) >= 10_000:
                        yield rows()
        if out:
            yield rows()

    ordered = sizes.select("height", "bytes", "forced").where(F.col("height") > previous).repartition(1).sortWithinPartitions("height")
    return ordered.mapInArrow(run, PLAN)


def chunks(plan: DataFrame) -> DataFrame:
    """One row a written chunk: (chunk_from, chunk_to, chunk_bytes)."""
    return plan.where("height = chunk_to and chunk_bytes > 0").select("chunk_from", "chunk_to", "chunk_bytes")
