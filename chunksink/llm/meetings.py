"""Units (lines or documents) that have a key in common, found bucket by bucket.

A unit emits hashed keys; units of about equal size that share one meet. Keys
travel packed: entries of a slice of the input are sorted by bucket and stored as
byte planes, which compress well. A task holds one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunksink.llm import sequences
from chunksink.llm.arrow import map_batches

BUCKET_BITS = 10
KEY_BYTES = 5
PACKED = "bucket int, cells binary"
SAMPLE = 32
HOT_LEAST = 3
HOT_MOST = 50_000
_PLANES = KEY_BYTES + 8 + 4


def _planes(x: np.ndarray, kind: str, most: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), -1)[:, :most].T


def pack(key: np.ndarray, ids: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Entries as one row a bucket."""
    bucket = (key >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, low = bucket[order], key[order] >> np.uint64(64 - BUCKET_BITS - 8 * KEY_BYTES)
    table = np.concatenate([_planes(low, "<u8", KEY_BYTES), _planes(ids[order], "<i8", 8), _planes(size[order], "<u4", 4)])
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(bucket))[: len(first)]
    cells = [table[:, a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(cells, pa.binary())], ["bucket", "cells"])


def unpack(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, id and size of the entries whose key another entry has, by key."""
    table = np.concatenate([np.frombuffer(c, np.uint8).reshape(_PLANES, -1) for c in cells], axis=1)

    def whole(planes: np.ndarray, kind: str) -> np.ndarray:
        wide = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
        wide[:, : len(planes)] = planes.T
        return wide.view(kind).ravel()

    key = whole(table[:KEY_BYTES], "<u8")
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    met = np.append(same, False) | np.append(False, same) if len(key) else np.zeros(0, bool)
    rest = table[KEY_BYTES:, order[met]]
    return key[met], whole(rest[:8], "<i8"), whole(rest[8:], "<u4").astype(np.int64)


def settle(cells: list[bytes], close: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(group, id) of the entries of a bucket that meet another of a size that ``close(less, more)`` allows.

    Groups with the same members are one.
    """
    key, ids, size = unpack(cells)
    if not len(key):
        return ids, ids
    order = np.lexsort((ids, size, key))
    key, ids, size = key[order], ids[order], size[order]
    new = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]))
    key, ids, size = key[new], ids[new], size[new]
    near = (key[1:] == key[:-1]) & close(size[:-1], size[1:])
    met = np.append(near, False) | np.append(False, near)
    begins = np.append(True, ~near)[met]  # sizes of a group follow one another without a gap
    ids = ids[met]
    if not len(ids):
        return ids, ids
    first = np.flatnonzero(begins)
    members = sequences.mix(np.add.reduceat(sequences.mix(ids.view(np.uint64)), first))
    group = np.repeat(members, np.diff(np.append(first, len(ids)))).view(np.int64)
    order = np.lexsort((ids, group))
    group, ids = group[order], ids[order]
    new = np.append(True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1]))
    return group[new], ids[new]


def meet(packed: DataFrame, close: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(key, id): groups of units that meet, of packed entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            group, ids = settle(held, close)
            return pa.RecordBatch.from_arrays([pa.array(group), pa.array(ids)], ["key", "id"])

        for batch in batches:
            for bucket, cells in zip(*(batch.column(c).to_pylist() for c in ("bucket", "cells")), strict=True):
                if bucket != now and held:
                    yield done()
                    held = []
                now = bucket
                held.append(cells)
        if held:
            yield done()

    return map_batches(packed.select("bucket", "cells").repartition("bucket").sortWithinPartitions("bucket"), run, "key long, id long").distinct()


def hot(docs: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """The most frequent keys of a sample of the documents, sorted. They only steer an order, never the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for h in keys(whole):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLE)) == 0)
    rows = map_batches(some, run, "h long").groupBy("h").count().where(F.col("count") >= HOT_LEAST).orderBy(F.desc("count"), "h").limit(HOT_MOST).collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def is_hot(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``h`` are in ``known``; a table of their low bits spares most searches."""
    out = np.zeros(len(h), bool)
    if len(known):
        table = np.zeros(1 << 20, bool)
        table[(known & np.uint64(len(table) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(table[(h & np.uint64(len(table) - 1)).astype(np.int64)])
        out[maybe] = known[np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)] == h[maybe]
    return out
