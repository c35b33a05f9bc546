"""Long repeated passages: which words or bytes lie in windows that occur elsewhere.

A window is ``length`` consecutive symbols of one document. Every window belongs
to one segment, and equal windows have equal anchors (``sequences.segments``),
so segments meet in shards by anchor. Anchors that no second place shares are
dropped first, equal segments collapse to one (aggregated before the shuffle),
and only texts that differ around a shared anchor are indexed, shard by shard:

* ``earlier`` (words): an FM-index of the shard gives, by backward search, the
  smallest document of each window; a window counts if that one is smaller.
* ``anywhere`` (bytes): a difference-cover suffix sort of the shard; a window
  counts if an adjacent suffix has the same prefix.

An anchor with more than ``hot`` different segments is not indexed in one task: its
windows are hashed singly (128 bits) and counted, an exact way with no group to hold.

Null and empty texts have no windows. Rows with a null id stay as they are and
are no source of repeats. Rows that share an id share the removed spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches
from chunksink.llm import sequences
from chunksink.llm.bpe import slices, with_column
from chunksink.llm.fm_index import FMIndex
from chunksink.llm.scratch import cut, hot_keys, small, split_join, temporary, unused
from chunksink.llm.suffix_sort import repeated_starts

SLICE_BYTES = 1 << 20
SHARD_BYTES = {"word": 3 << 20, "byte": 1 << 20}
HOT = 4096
SPAN = "doc_id long, s long, e long"


def _texts(unit: str, values: list[str | None]) -> sequences.Texts:
    return sequences.join_texts(unit, [(t or "").encode("utf-8") for t in values])


def segment_rows(docs: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """(anchor, content, doc_id, s, e, inner): the segments of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                g = sequences.segments(_texts(unit, batch.column("text").to_pylist()), length, gram)
                columns = (g.anchor, g.content, ids[g.text], g.start.astype(np.int32), g.end.astype(np.int32), g.inner)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "doc_id", "s", "e", "inner"])

    return map_batches(docs, run, "anchor long, content long, doc_id long, s int, e int, inner boolean")


def repeated_spans(docs: DataFrame, unit: str, length: int, gram: int, earlier: bool, hot: int = HOT) -> DataFrame:
    """(doc_id, spans): for each document with any, its spans of repeated symbols, merged and in order."""
    with temporary(docs.sparkSession):
        docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
        return cut(_repeated_spans(docs, unit, length, gram, earlier, hot), "spans", keep=True)


def _repeated_spans(docs: DataFrame, unit: str, length: int, gram: int, earlier: bool, hot: int) -> DataFrame:
    rows = cut(segment_rows(docs, unit, length, gram), "segments")
    stats = rows.groupBy("anchor").agg(
        (F.min("content") != F.max("content")).alias("differ"), (F.min("doc_id") != F.max("doc_id")).alias("several"), F.count("*").alias("places"), F.max("inner").alias("inner")
    )
    shared = F.col("several") if earlier else (F.col("places") > 1) | F.col("inner")
    mixed = F.col("differ") if earlier else F.col("differ") | F.col("inner")
    stats = cut(stats.where(shared).select("anchor", mixed.alias("mixed"), "places"), "segments")
    met = cut(split_join(rows.drop("inner"), stats.drop("places"), ["anchor"], hot_keys(stats, ["anchor"], "places"), ["doc_id", "s"]), "segments")
    both = ["anchor", "content"]
    same = cut(met.groupBy(both).agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.max("mixed").alias("mixed")), "segments")
    met = split_join(met.drop("mixed"), same, both, hot_keys(same, both, "n"), ["doc_id", "s"])
    repeated = F.col("doc_id") > F.col("least") if earlier else F.col("n") > 1
    found = met.where(repeated).select("doc_id", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    wanted = met.where(F.col("mixed") & (F.col("doc_id") == F.col("least"))).withColumn("twice", F.col("n") > 1)
    many = cut(same.where("mixed").groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "segments")
    if many.isEmpty():
        cold = wanted
    else:
        cold = wanted.join(small(many), "anchor", "left_anti")
        found = found.union(_hot(_bodies(docs, wanted.join(small(many), "anchor", "left_semi"), unit), unit, length, earlier))
    shards = _bodies(docs, cold, unit).repartition("anchor").sortWithinPartitions("anchor")
    found = found.union(map_batches(shards, _index(unit, length, earlier), SPAN))
    return _merged(found)


def _bodies(docs: DataFrame, wanted: DataFrame, unit: str) -> DataFrame:
    """(anchor, doc_id, s, twice, body): the text of the wanted segments; words are joined by one space."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "s", "e", "twice")).alias("parts"))  # no more than the document holds
    both = docs.join(lists.hint("shuffle_hash"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                t = _texts(unit, batch.column("text").to_pylist())
                parts = batch.column("parts")
                of = np.repeat(np.arange(batch.num_rows), parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
                flat = parts.flatten()
                s, e = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("s", "e"))
                most = np.diff(t.first)[of]
                fits = e <= most  # rows that share an id may have another text
                at = t.first[of]
                begin, end = t.start[np.where(fits, at + s, 0)], t.end[np.where(fits, at + e - 1, 0)]
                cells = [t.buffer[a:b] if ok else b"" for a, b, ok in zip(begin.tolist(), end.tolist(), fits.tolist(), strict=True)]
                if unit == "word":
                    cells = [b" ".join(c.split()) for c in cells]
                yield pa.RecordBatch.from_arrays(
                    [flat.field("anchor"), batch.column("doc_id").take(pa.array(of)), pa.array(s), flat.field("twice"), pa.array(cells, pa.binary())], ["anchor", "doc_id", "s", "twice", "body"]
                )

    return map_batches(both.select("doc_id", "text", "parts"), run, "anchor long, doc_id long, s long, twice boolean, body binary")


def _index(unit: str, length: int, earlier: bool):
    """Spans of repeated windows among the bodies of a shard; an anchor is never cut in two."""
    look = _look_words if unit == "word" else _look_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            for batch in slices(whole, "body", SHARD_BYTES[unit]):
                held.append(batch)
                size += batch.column("body").nbytes
                if size >= SHARD_BYTES[unit]:
                    table = pa.Table.from_batches(held).combine_chunks()
                    anchor = table.column("anchor").to_numpy()
                    last = int(np.searchsorted(anchor, anchor[-1]))
                    if last:
                        yield look(table.slice(0, last), length, earlier)
                        table = table.slice(last)
                    held = table.to_batches()
                    size = sum(len(x.as_buffer()) for x in table.column("body"))
        if held:
            yield look(pa.Table.from_batches(held), length, earlier)

    return run


def _spans(doc: np.ndarray, s: np.ndarray, row: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    row, a, b = sequences.merge_spans(row, start, start + length)
    return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(s[row] + a), pa.array(s[row] + b)], ["doc_id", "s", "e"])


def _look_words(table: pa.Table, length: int, earlier: bool) -> pa.RecordBatch:
    doc, s = table.column("doc_id").to_numpy(), table.column("s").to_numpy()
    number: dict[bytes, int] = {}
    known: dict[bytes, int] = {}
    of, texts, owners = [], [], []
    for body, d in zip(table.column("body").to_pylist(), doc.tolist(), strict=True):
        k = known.setdefault(body, len(known))
        if k == len(texts):
            words = body.split(b" ")
            texts.append(np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words)))
            owners.append(d)
        owners[k] = min(owners[k], d)
        of.append(k)
    index = FMIndex(texts, np.array(owners), length)
    query, start, least = index.matches([texts[k] for k in of])
    repeated = least < doc[query]
    return _spans(doc, s, query[repeated], start[repeated], length)


def _look_bytes(table: pa.Table, length: int, earlier: bool) -> pa.RecordBatch:
    doc, s = table.column("doc_id").to_numpy(), table.column("s").to_numpy()
    twice = table.column("twice").to_numpy()
    bodies = table.column("body").to_pylist()
    first: dict[bytes, int] = {}
    for k, body in enumerate(bodies):
        first.setdefault(body, k)
    own = np.fromiter(first.values(), np.int64, len(first))
    part, start = repeated_starts([bodies[k] for k in own.tolist()], length)
    row = own[part]
    once = ~twice[row]  # the others are repeated as a whole, which is known
    return _spans(doc, s, row[once], start[once], length)


def _hot(bodies: DataFrame, unit: str, length: int, earlier: bool) -> DataFrame:
    """Repeated windows of bodies under hot anchors, by the hashes of single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "body", SLICE_BYTES >> 4):
                t = sequences.join_texts(unit, batch.column("body").to_pylist())
                if len(t.symbols) < length:
                    continue
                one, two = (sequences.Rolling(t.symbols, k).each(length) for k in (0, 1))
                at = np.arange(len(one))
                of = np.searchsorted(t.first, at, side="right") - 1
                inside = at + length <= t.first[of + 1]
                at, of = at[inside], of[inside]
                doc, s = (batch.column(c).to_numpy() for c in ("doc_id", "s"))
                columns = (one[at].view(np.int64), two[at].view(np.int64), doc[of], s[of] + at - t.first[of])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "doc_id", "s"])

    windows = map_batches(bodies, run, "h1 long, h2 long, doc_id long, s long")
    places = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    places = cut(places.where("least < most" if earlier else "n > 1"), "windows")
    seen = split_join(windows, places, ["h1", "h2"], hot_keys(places, ["h1", "h2"], "n"), ["doc_id", "s"])
    if earlier:
        seen = seen.where("doc_id > least")
    return seen.select("doc_id", "s", (F.col("s") + length).alias("e"))


def _merged(found: DataFrame) -> DataFrame:
    """Spans of a document, merged."""
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw")
            of = np.repeat(np.arange(batch.num_rows), raw.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            flat = raw.flatten()
            row, s, e = sequences.merge_spans(of, flat.field("s").to_numpy(), flat.field("e").to_numpy())
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(s), pa.array(e)], ["s", "e"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], ["doc_id", "spans"])

    return map_batches(lists, run, "doc_id long, spans array<struct<s:long,e:long>>")


def remove_spans(docs: DataFrame, spans: DataFrame, unit: str) -> DataFrame:
    """``docs`` with ``n_units``, ``n_removed``, ``n_spans`` and ``kept``.

    ``kept`` is binary: the words left, joined by one space, or the bytes left.
    These four replace columns of their names; every other column passes through.
    """
    (own,) = unused(docs, "spans")
    both = docs.drop("n_units", "n_removed", "n_spans", "kept").join(spans.withColumnRenamed("spans", own).hint("shuffle_hash"), "doc_id", "left")
    fields = [f for f in both.schema.fields if f.name != own]
    long = T.LongType()
    schema = T.StructType([*fields, *(T.StructField(c, long) for c in ("n_units", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])

    def one(text: str | None, spans: list[dict] | None) -> tuple[int, int, int, bytes]:
        raw = (text or "").encode("utf-8")
        units = raw.split() if unit == "word" else raw
        n, at, removed, kept, count = len(units), 0, 0, [], 0
        for x in spans or ():
            a, b = min(x["s"], n), min(x["e"], n)
            if a < b:
                kept.append(units[at:a])
                removed, at, count = removed + b - a, b, count + 1
        kept.append(units[at:])
        return n, removed, count, b" ".join(w for k in kept for w in k) if unit == "word" else b"".join(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES << 2):
                done = [one(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column(own).to_pylist(), strict=True)]
                columns = list(zip(*done, strict=True))
                out = pa.RecordBatch.from_arrays([batch.column(f.name) for f in fields], [f.name for f in fields])
                for name, values, kind in zip(("n_units", "n_removed", "n_spans", "kept"), columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True):
                    out = with_column(out, name, pa.array(values, kind))
                yield out

    return map_batches(both, run, schema)


def drop_seen_passages(docs: DataFrame, words: int = 50, gram: int = 8, hot: int = HOT) -> DataFrame:
    """Remove words covered by ``words``-word windows that also start in a document with a smaller id."""
    return remove_spans(docs, repeated_spans(docs, "word", words, min(gram, words), True, hot), "word")


def drop_repeated_bytes(docs: DataFrame, length: int = 400, gram: int = 64, hot: int = HOT) -> DataFrame:
    """Remove bytes covered by ``length``-byte strings that also start anywhere else."""
    return remove_spans(docs, repeated_spans(docs, "byte", length, min(gram, length), False, hot), "byte")
