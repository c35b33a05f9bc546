"""SimHash fingerprints and their linking within a Hamming distance.

Fingerprints come from lower-cased (A-Z) words and shingles of ``SHINGLE`` words.
Equal fingerprints collapse first. Every pair within ``budget`` bits agrees on
one of ``budget + 1`` blocks of bits, so a bucket per block and value holds all
candidates. Inside a bucket the binary trie of its fingerprints joins itself:
node pairs descend together, differing bits add up, and a pair over the budget
is dropped. A bucket above ``SPLIT`` members is dealt out as pairs of trie nodes
below its first bits, so no task receives a whole hot bucket. A bucket passes on
a spanning forest of its links, which keeps every component.

Null and empty texts have fingerprint zero. Repeated ids keep their rows; a null
id is no label, so such a row takes the smallest id it is linked with, if any.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches
from chunksink.llm.bpe import slices, with_column
from chunksink.llm.components import components
from chunksink.llm.scratch import cut, hot_keys, split_join, temporary

SHINGLE = 4
BUDGET = 4
SPLIT = 4096
SPACE_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``out``: the 64-bit fingerprint of the whole text, as a signed long."""
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != out), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        xxh = xxhash.xxh64_intdigest

        def of(value: str | None) -> int:
            words = (value or "").encode("utf-8").translate(SPACE_TABLE).split(b" ")
            words = [w for w in words if w]
            if not words:
                return 0
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            n = max(1, len(words) - shingle + 1)
            starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
            stops = ends[len(words) - n :].tolist()
            h = np.array([xxh(line[a:b], 42) for a, b in zip(starts, stops, strict=True)], "<u8")
            ones = np.zeros(64, np.int64)
            for at in range(0, n, 8192):
                bits = np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])

        for whole in batches:
            for batch in slices(whole, text):
                yield with_column(batch, out, pa.array([of(t) for t in batch.column(text).to_pylist()], pa.int64()))

    return map_batches(docs, run, schema)


def block_masks(budget: int = BUDGET) -> list[int]:
    """``budget + 1`` masks that divide the 64 bits into runs, highest bits first."""
    cuts = [64 * k // (budget + 1) for k in range(budget + 2)]
    return [((1 << (b - a)) - 1) << (64 - b) for a, b in zip(cuts, cuts[1:], strict=False)]


def trie_join(values: np.ndarray, roots: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], budget: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``values`` (uint64) within ``budget`` bits; each pair once, in bounded pieces.

    ``roots`` gives node pairs as ranges (a0, a1, b0, b1): a range holds sorted
    distinct values, and the two of a pair are the same range or disjoint.
    """
    stack = [(63, *roots, np.zeros(len(roots[0]), np.int64))]
    while stack:
        bit, a0, a1, b0, b1, used = stack.pop()
        if len(a0) > most:
            for part in np.array_split(np.arange(len(a0)), -(-len(a0) // most)):
                stack.append((bit, a0[part], a1[part], b0[part], b1[part], used[part]))
            continue
        few = (a1 - a0) * (b1 - b0) <= 64 if bit >= 0 else np.ones(len(a0), bool)
        if few.any():  # few leaves below: compare them at once
            x0, y0, wide = a0[few], b0[few], (b1 - b0)[few]
            count = (a1 - a0)[few] * wide
            for part in np.array_split(np.arange(len(count)), max(1, int(count.sum()) // most)):
                k = np.repeat(part, count[part])
                j = np.arange(len(k)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
                x, y = x0[k] + j // wide[k], y0[k] + j % wide[k]
                near = (x < y) & (np.bitwise_count(values[x] ^ values[y]) <= budget)
                if near.any():
                    yield x[near], y[near]
            a0, a1, b0, b1, used = (c[~few] for c in (a0, a1, b0, b1, used))
        if not len(a0):
            continue
        am, bm = _first_one(values, a0, a1, bit), _first_one(values, b0, b1, bit)
        apart = a0 != b0
        parts = []
        for x0, x1, y0, y1, cost, wanted in ((a0, am, b0, bm, 0, True), (am, a1, bm, b1, 0, True), (a0, am, bm, b1, 1, True), (am, a1, b0, bm, 1, apart)):
            ok = (x0 < x1) & (y0 < y1) & (used + cost <= budget) & wanted
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], used[ok] + cost))
        stack.append((bit - 1, *(np.concatenate(c) for c in zip(*parts, strict=True))))


def _first_one(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """First index in [lo, hi) whose value has ``bit``; values are sorted and agree above it."""
    mask = np.uint64(1 << bit)
    lo, hi = lo.copy(), hi.copy()
    todo = np.flatnonzero(lo < hi)
    while len(todo):
        mid = (lo[todo] + hi[todo]) // 2
        one = (values[mid] & mask) != 0
        hi[todo[one]] = mid[one]
        lo[todo[~one]] = mid[~one] + 1
        todo = todo[lo[todo] < hi[todo]]
    return lo


class Forest:
    """Union-find over positions, for the links of one bucket."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.find(x), self.find(y)
            far = a != b
            if not far.any():
                return
            a, b, x, y = a[far], b[far], x[far], y[far]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def find(self, x: np.ndarray) -> np.ndarray:
        r = self.root[x]
        while True:
            up = self.root[r]
            if (up == r).all():
                self.root[x] = r
                return r
            r = up


def links(fps: DataFrame, budget: int = BUDGET, split: int = SPLIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span every component at ``budget`` bits."""
    masks = block_masks(budget)
    blocks = [F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("value")) for k, m in enumerate(masks)]
    keyed = fps.select("fp", F.explode(F.array(*blocks)).alias("key")).select("fp", "key.*")
    sizes = keyed.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    depth = F.when(F.col("n") > split, F.least(F.lit(16), F.ceil(F.log2(F.col("n") / split)))).otherwise(0).cast("int")
    dealt = keyed.join(sizes.select("block", "value", depth.alias("depth")), ["block", "value"])

    def node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A hot bucket goes out by its first ``depth`` free bits, once for each trie node in reach."""
        for batch in batches:
            block, value, fp, depth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "value", "fp", "depth"))
            for d, k in set(zip(depth.tolist(), block.tolist(), strict=True)):
                own = (depth == d) & (block == k)
                v = fp[own].view(np.uint64)
                node = np.zeros(len(v), np.int64)
                for b in [b for b in range(63, -1, -1) if not masks[k] >> b & 1][:d]:
                    node = node * 2 + (v >> np.uint64(b) & np.uint64(1)).astype(np.int64)
                for bits in range(min(budget, d) + 1):
                    for flips in combinations(range(d), bits):
                        other = node ^ sum(1 << f for f in flips)
                        columns = (block[own], value[own], np.minimum(node, other), np.maximum(node, other), (node > other).astype(np.int32), fp[own])
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "value", "low", "high", "side", "fp"])

    key = ["block", "value", "low", "high"]
    order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned
    paired = map_batches(dealt.select("block", "value", "fp", "depth"), node_pairs, "block int, value long, low long, high long, side int, fp long")
    paired = paired.repartition(*key).sortWithinPartitions(*key, "side", order)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= 200_000:
                table = pa.concat_tables(held).combine_chunks()
                ends = _bucket_ends(table, key)
                if len(ends) > 1:
                    yield _forest(table.slice(0, ends[-2]), key, budget)
                    table = table.slice(ends[-2])
                held, rows = [table], table.num_rows
        if rows:
            yield _forest(pa.concat_tables(held).combine_chunks(), key, budget)

    return map_batches(paired, join, "a long, b long")


def _bucket_ends(table: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(max(0, table.num_rows - 1), bool)
    for c in key:
        new |= np.diff(table.column(c).to_numpy()) != 0
    return np.append(np.flatnonzero(new) + 1, table.num_rows)


def _forest(table: pa.Table, key: list[str], budget: int) -> pa.RecordBatch:
    """Links of whole buckets, at most one a row."""
    fp = np.ascontiguousarray(table.column("fp").to_numpy())
    ends = _bucket_ends(table, key)
    starts = np.append(0, ends[:-1])
    side = np.append(0, np.cumsum(table.column("side").to_numpy()))
    middle = ends - (side[ends] - side[starts])  # where the second node of a pair begins
    alone = table.column("low").to_numpy()[starts] == table.column("high").to_numpy()[starts]
    roots = starts, np.where(alone, ends, middle), np.where(alone, starts, middle), ends
    forest = Forest(len(fp))
    for x, y in trie_join(fp.view(np.uint64), roots, budget):
        forest.add(x, y)
    root = forest.find(np.arange(len(fp)))
    away = root != np.arange(len(fp))
    return pa.RecordBatch.from_arrays([pa.array(fp[root[away]]), pa.array(fp[away])], ["a", "b"])


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row a document: its id, ``fp`` and ``component_id``, the smallest id reachable over links."""
    with temporary(docs.sparkSession):
        return cut(_linked(docs.select(doc_id, text), doc_id, text, budget), "components", keep=True)


def _linked(docs: DataFrame, doc_id: str, text: str, budget: int) -> DataFrame:
    found = cut(fingerprints(docs, text).select(doc_id, "fp"), "fingerprints")
    distinct = cut(found.groupBy("fp").agg(F.min(doc_id).alias("least"), F.count("*").alias("n")), "fingerprints")
    linked = components(links(distinct.select("fp"), budget))
    classes = cut(distinct.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprints")
    least = cut(classes.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "fingerprints")
    of_fp = split_join(classes, least.drop("n"), ["root"], hot_keys(least, ["root"], "n"), ["fp"]).select("fp", "component_id")
    return split_join(found, of_fp, ["fp"], hot_keys(distinct, ["fp"], "n"), [doc_id]).select(doc_id, "fp", "component_id")
