"""Line dedup: lines within a few word edits of an earlier line go.

A line is the words of one ``\\n``-separated line; lines without a word stay.
Line x is earlier than y if its document's id is smaller, or the same and x
stands above. A line goes if an earlier line has the same words or, for lines of
``MIN_WORDS`` words or more, differs by words inserted, deleted or replaced: one
for every ``WORDS_PER_EDIT`` words of the shorter line, and one at least. All lines are judged on the input, so the result has no order of evaluation.

Equal lines collapse first. Two lines within one edit share their first or last
half, so lines that share no half with another are settled. The others emit
their deletion neighbourhood as hashed keys: the line without word i, for every
i in the half that may differ. Lines meet by equal variants, the earliest of a
variant stands for it, and each meeting is verified by the edit distance of the
words. Every step aggregates by key before it joins, so a hot line or variant is
no group that a task has to hold. The sides of the joins grow with the corpus, so
they shuffle at every size.

Lines of ``FAR_WORDS`` words or more may have k = 2 edits and up. Their whole
neighbourhood is too large to emit (k of n words); its members that matter are
those in which all but a run of words is deleted: k edits leave a run of
(n - k) / (k + 1) words untouched. From every run a line emits the least hash of its
ranges of ``GRAM`` words, so lines within the bound meet at one. Pairs whose lengths,
or whose bags of words (as counts modulo two of hashed words, which grow with the line),
differ by more than the edits can explain are dropped unread. The lines of a meeting
stream in their order past its first ``HELD``, and each is verified against the earliest that
is left. Only a line that is not near it, and that has further such lines or comes after
these, is held against all earlier ones of its meetings.

Null and empty texts have no lines. Rows with a null id stay as they are and
are no source. Rows that share an id lose the same line numbers as the first
that holds them; a removed line is found again by its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches
from chunksink.llm import sequences
from chunksink.llm.bpe import slices, with_column
from chunksink.llm.meetings import PACKED, hot, is_hot, meet, pack
from chunksink.llm.scratch import cut, cut_apart, hot_keys, small, split_join, temporary, unused

MIN_WORDS = 8
WORDS_PER_EDIT = 10
GRAM = 4
#: Words from which a line may have two edits.
FAR_WORDS = 2 * WORDS_PER_EDIT
SLICE_BYTES = 1 << 20
PACK_KEYS = 1 << 19
_TOP = np.uint64(1 << 63)
LINE = "c1 long, c2 long, n int, doc_id long, line int"
HALVES = "pre long, suf long, pre2 long, suf2 long"
PARITY = ["p0", "p1", "p2", "p3", "more"]
#: Space other than single blanks between words and the ends of lines.
_ODD_SPACE = r"[\t\x0b\x0c\r]|  |^ | $|\n | \n"
#: Lines of a meeting, the earliest, that each of its lines is held against before any other.
HELD = 1024
#: Words beyond which a line has more than 256 parities.
LONG_WORDS = 64


def _lines(parts: list[bytes]) -> tuple[sequences.Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts; and of each line with a word: text number, line number, first and last word."""
    t = sequences.word_texts(parts)
    raw = np.frombuffer(t.buffer, np.uint8)
    breaks = np.flatnonzero(raw == 10)
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    a = np.unique(np.concatenate([t.first[:-1], np.searchsorted(t.start, breaks)]))  # words at the head of a text or a line
    a = a[a < len(t.start)]
    b = np.append(a[1:], len(t.start))[: len(a)]
    text = np.searchsorted(t.first, a, side="right") - 1
    return t, text, np.searchsorted(breaks, t.start[a]) - np.searchsorted(breaks, offsets)[text], a, b


def _contents(lines: list[bytes]) -> np.ndarray:
    """The content hash ``c1`` of each line."""
    t = sequences.word_texts(lines)
    return sequences.Rolling(t.symbols).of(t.first[:-1], t.first[1:]).view(np.int64)


def run_of(n: np.ndarray) -> np.ndarray:
    """Words in a row, at least, that edits leave untouched between a line of ``n`` words and a shorter one within the bound."""
    k = np.maximum(n - n // WORDS_PER_EDIT, FAR_WORDS) // WORDS_PER_EDIT
    return -(-((WORDS_PER_EDIT - 1) * k) // (k + 1))


def far_keys(t: sequences.Texts, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of lines of ``FAR_WORDS`` words or more: in every run of ``run_of`` words, the least hash of its ranges of ``GRAM`` words.

    Two lines with a run in common have its key in common, also if the shorter looks
    at shorter runs. Ranges that are hot come last in the order.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    long = np.flatnonzero(b - a >= FAR_WORDS)
    if not len(long):
        return none
    least = sequences.Rolling(t.symbols).each(GRAM)
    least = np.where(is_hot(least, known), least | _TOP, least & ~_TOP)
    width = run_of(b[long] - a[long]) - GRAM + 1
    lines, keys = [], []
    for w in range(1, WORDS_PER_EDIT - GRAM + 1):
        own = long[width == w]
        if len(own):
            count = b[own] - a[own] - GRAM + 1 - w + 1
            of = np.repeat(own, count)
            at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + a[of]
            key = least[at]
            new = np.append(True, (key[1:] != key[:-1]) | (of[1:] != of[:-1]))
            lines.append(of[new])
            keys.append(sequences.mix(key[new]))
        least = np.minimum(least[:-1], least[1:])
    return np.concatenate(lines), np.concatenate(keys)


def half_keys(n: np.ndarray, pre: np.ndarray, suf: np.ndarray, pre2: np.ndarray, suf2: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of lines of ``min_words`` to ``FAR_WORDS`` words: their first and last halves, rounded down and, of an even number, also less one word."""
    some = np.flatnonzero((n >= min_words) & (n <= FAR_WORDS))
    even = some[n[some] % 2 == 0]
    of = np.concatenate([some, some, even, even])
    tail = np.repeat(np.array([1, 2, 1, 2], np.uint64), [len(some), len(some), len(even), len(even)])
    return of, sequences.mix(np.concatenate([pre[some], suf[some], pre2[even], suf2[even]]) ^ tail * np.uint64(0xC2B2AE3D27D4EB4F))


def parities(t: sequences.Texts) -> tuple[np.ndarray, pa.Array]:
    """Of each text the counts modulo two of its words by 256 values of their hash; for texts of over ``LONG_WORDS`` words also by four to eight times as many as words.

    The second and later places of a word in a text count as other words. An edit
    takes one word at most and brings one, so it changes two of these at most.
    """
    n = np.diff(t.first)
    of = np.repeat(np.arange(len(n)), n)
    order = np.argsort(sequences.mix(t.symbols + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))  # equal words of a text stand together
    word, own = t.symbols[order], of[order]
    at = np.arange(len(own))
    again = at - np.maximum.accumulate(np.where(np.append(True, (word[1:] != word[:-1]) | (own[1:] != own[:-1])), at, 0)) if len(own) else at
    item = sequences.mix(word + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def odd(text: np.ndarray, item: np.ndarray, rows: int, cells: int) -> np.ndarray:
        count = np.bincount(text * cells + (item & np.uint64(cells - 1)).astype(np.int64), minlength=rows * cells).reshape(rows, cells)
        return np.packbits((count & 1).astype(np.uint8), axis=1).view(np.int64)

    size = np.where(n > LONG_WORDS, 1 << np.ceil(np.log2(4 * np.maximum(n, 1))).astype(np.int64), 0)
    ends = np.cumsum(size >> 6)
    more = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    for cells in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == cells)
        number = np.full(len(n), -1)
        number[rows] = np.arange(len(rows))
        mine = number[own] >= 0
        made = odd(number[own[mine]], item[mine], len(rows), cells)
        more[(np.repeat(ends[rows] - (cells >> 6), cells >> 6).reshape(len(rows), -1) + np.arange(cells >> 6)).ravel()] = made.ravel()
    return odd(own, item, len(n), 256), pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(more))


def line_rows(docs: DataFrame, far: bool = False, min_words: int = MIN_WORDS) -> DataFrame:
    """One row a distinct line of each document, at its first place: content hashes, words, place; and hashes of halves.

    With ``far``, in place of these, packed keys of halves and runs, in rows of their own, which have a bucket.
    """
    held = docs.sparkSession.sparkContext.broadcast(hot(docs, _grams) if far else None)
    names = ["c1", "c2", "n", "doc_id", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def halves(one: sequences.Rolling, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
            h, g = n // 2, (n - 1) // 2
            return one.of(a, a + h), one.of(b - h, b), one.of(a, a + g), one.of(b - g, b)

        def packed() -> pa.RecordBatch:
            out = pack(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            return pa.RecordBatch.from_arrays([*(pa.nulls(out.num_rows, f.type) for f in kinds), *out.columns], [*names, "bucket", "cells"])

        kinds = pa.schema([pa.field(c, pa.int32() if c in ("n", "line") else pa.int64()) for c in names])
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                t, text, line, a, b = _lines([(x or "").encode("utf-8") for x in batch.column("text").to_pylist()])
                one, two = sequences.Rolling(t.symbols, 0), sequences.Rolling(t.symbols, 1)
                c1, c2, n = one.of(a, b), two.of(a, b), b - a
                order = np.lexsort((line, c1, text))
                first = np.ones(len(order), bool)
                first[1:] = (c1[order][1:] != c1[order][:-1]) | (text[order][1:] != text[order][:-1])
                k = np.sort(order[first])
                c1, c2, n, a, b, text, line = (x[k] for x in (c1, c2, n, a, b, text, line))
                plain = [pa.array(x) for x in (c1.view(np.int64), c2.view(np.int64), n.astype(np.int32), ids[text], line.astype(np.int32))]
                if not far:
                    yield pa.RecordBatch.from_arrays([*plain, *(pa.array(x.view(np.int64)) for x in halves(one, n, a, b))], [*names, "pre", "suf", "pre2", "suf2"])
                    continue
                yield pa.RecordBatch.from_arrays([*plain, pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], [*names, "bucket", "cells"])
                _, one_each = np.unique(c1, return_index=True)  # copies that stand close together go out once
                n, a, b, c1 = (x[one_each] for x in (n, a, b, c1))
                of, key = (np.concatenate(x) for x in zip(far_keys(t, a, b, held.value), half_keys(n, *halves(one, n, a, b), min_words), strict=True))
                waiting.append((key, c1.view(np.int64)[of], n[of]))
                size += len(key)
                if size >= PACK_KEYS:
                    yield packed()
                    waiting, size = [], 0
        if size:
            yield packed()

    return map_batches(docs, run, f"{LINE}, {PACKED if far else HALVES}")


def _grams(whole: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Distinct ranges of ``GRAM`` words of each slice; hot ones stand in many."""
    for batch in slices(whole, "text", SLICE_BYTES):
        for part in batch.column("text").to_pylist():
            t = sequences.word_texts([(part or "").encode("utf-8")])
            if len(t.symbols) >= GRAM:
                yield np.unique(sequences.Rolling(t.symbols).each(GRAM))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """Each distinct line with its earliest place."""
    return rows.groupBy("c1", "c2", "n").agg(F.min("doc_id").alias("doc_id"), F.min_by("line", "doc_id").alias("line"), F.count("*").alias("places"))


def half_sharers(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Contents whose first (``head``) or last (``tail``) half other contents share."""
    key = lambda hash_, tail: F.struct(F.xxhash64(hash_, F.lit(tail)).alias("key"), F.lit(tail).alias("tail"))
    even = F.col("n") % 2 == 0
    keys = F.when(even, F.array(key("pre", 0), key("suf", 1), key("pre2", 0), key("suf2", 1))).otherwise(F.array(key("pre", 0), key("suf", 1)))
    each = rows.where(F.col("n") >= min_words).select("c1", F.explode(keys).alias("k")).select("c1", "k.*")
    shared = each.groupBy("key").agg((F.min("c1") != F.max("c1")).alias("met")).where("met").select("key")
    return each.join(shared, "key").groupBy("c1").agg(F.max(F.col("tail") == 0).alias("head"), F.max(F.col("tail") == 1).alias("tail"))


def line_texts(docs: DataFrame, wanted: DataFrame, signed: bool = False) -> DataFrame:
    """(c1, c2, n, doc_id, line, head, tail, words): the words of the wanted lines at their places; and, if ``signed``, their parities."""
    lists = cut(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line", "c1", "c2", "head", "tail")).alias("parts")), "lines")
    both = docs.join(lists.hint("shuffle_hash"), "doc_id")
    names = ["c1", "c2", "doc_id", "line", "head", "tail", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                size = batch.column("parts").value_lengths().to_numpy(zero_copy_only=False)
                parts = batch.column("parts").flatten()
                at = {f.name: parts.field(i) for i, f in enumerate(parts.type)}
                number, ends = at["line"].to_pylist(), np.cumsum(size).tolist()
                words: list[bytes | None] = []
                for text, k, end in zip(batch.column("text").to_pylist(), size.tolist(), ends, strict=True):
                    lines = (text or "").encode("utf-8").split(b"\n")
                    words += [b" ".join(lines[i].split()) if i < len(lines) else None for i in number[end - k : end]]
                held = pa.array(words, pa.binary())
                ids = pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), size))
                made = [x.filter(held.is_valid()) for x in (at["c1"], at["c2"], ids, at["line"], at["head"], at["tail"], held)]
                if len(made[0]):
                    if signed:
                        t = sequences.word_texts(made[-1].to_pylist())
                        few, more = parities(t)
                        made += [pa.array(np.diff(t.first).astype(np.int32)), *map(pa.array, few.T), more]
                    yield pa.RecordBatch.from_arrays(made, [*names, "n", *PARITY] if signed else names)

    schema = "c1 long, c2 long, doc_id long, line int, head boolean, tail boolean, words binary"
    return map_batches(both.select("doc_id", "text", "parts"), run, f"{schema}, n int, p0 long, p1 long, p2 long, p3 long, more array<long>" if signed else schema)


def variants(lines: DataFrame) -> DataFrame:
    """The deletion neighbourhood: (key, full, c1, c2, doc_id, line).

    A line without word i is keyed alone, to meet a full line one word shorter,
    and together with i, to meet lines that differ in word i.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "words", SLICE_BYTES >> 3):
                t = sequences.word_texts(batch.column("words").to_pylist())
                n = np.diff(t.first)
                a = t.first[:-1]
                hash_ = sequences.Rolling(t.symbols)
                head, tail = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("head", "tail"))
                half = (n - 1) // 2
                low, high = np.where(tail, 0, half), np.where(head, n, n - half)
                count = np.maximum(high - low, 0)
                of = np.repeat(np.arange(len(n)), count)
                i = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of]
                at = a[of] + i
                # Hash of the words left: both parts, the second moved back by one word.
                up, down = sequences.powers(sequences._BASES[0], len(t.symbols))
                before = (hash_.sums[at] - hash_.sums[a[of]]) * down[a[of]]
                after = (hash_.sums[t.first[of + 1]] - hash_.sums[at + 1]) * down[a[of] + 1]
                length = (n[of] - 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                left = sequences.mix((before + after) ^ length)
                replaced = sequences.mix(left ^ (i.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                full = hash_.of(a, t.first[1:])
                key = np.concatenate([left, replaced, full])
                row = np.concatenate([of, of, np.arange(len(n))])
                role = np.repeat(np.array([0, 1, 2], np.int8), [len(of), len(of), len(n)])
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(role), *(batch.column(c).take(take) for c in ("c1", "c2", "doc_id", "line"))], ["key", "role", "c1", "c2", "doc_id", "line"])

    return map_batches(lines, run, "key long, role byte, c1 long, c2 long, doc_id long, line int")


def meetings(neighbourhood: DataFrame) -> DataFrame:
    """(c1, c2, w1, w2): lines that meet an earlier line at a variant, and that line."""
    place = F.struct("doc_id", "line", "c1", "c2")
    own = F.col("role")
    first = neighbourhood.groupBy("key").agg(F.min(F.when(own == 0, place)).alias("longer"), F.min(F.when(own == 1, place)).alias("replaced"), F.min(F.when(own == 2, place)).alias("full"), F.count("*").alias("n")).where("n > 1").drop("n")
    witness = F.when(own == 0, F.col("full")).when(own == 1, F.col("replaced")).otherwise(F.col("longer"))
    met = neighbourhood.join(first, "key").withColumn("w", witness).where(F.col("w").isNotNull())
    earlier = (F.col("w.doc_id") < F.col("doc_id")) | ((F.col("w.doc_id") == F.col("doc_id")) & (F.col("w.line") < F.col("line")))
    return met.where(earlier).select("c1", "c2", F.col("w.c1").alias("w1"), F.col("w.c2").alias("w2")).distinct()


def edits_allowed(n: int) -> int:
    """Edits between lines of which the shorter has ``n`` words."""
    return max(1, n // WORDS_PER_EDIT)


def within_edits(a: list[bytes], b: list[bytes], most: int) -> bool:
    """Whether at most ``most`` words are inserted, deleted or replaced between two word sequences (Myers' bit vectors)."""
    if abs(len(a) - len(b)) > most:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[k:], b[k:]
    k = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - k], b[: len(b) - k]
    if not a or not b:
        return max(len(a), len(b)) <= most
    at: dict[bytes, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = full, 0
    for left, w in zip(range(len(b) - 1, -1, -1), b, strict=True):
        same = at.get(w, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        more, less = down | ~(h | up) & full, up & h
        score += bool(more & top) - bool(less & top)
        if score - left > most:
            return False
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | ~(v | more) & full, more & v
    return score <= most


def verified(met: DataFrame, lines: DataFrame, min_words: int, grows: bool = False) -> DataFrame:
    """(c1, c2) of the lines whose edit distance to a met line holds."""
    text = lines.select("c1", "c2", "words")
    both = met.join(text, ["c1", "c2"]).withColumnRenamed("words", "x").join(text.select(F.col("c1").alias("w1"), F.col("c2").alias("w2"), F.col("words").alias("y")), ["w1", "w2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = x.split(), y.split()
                n = min(len(a), len(b))
                most = edits_allowed(n) if grows else 1
                ok.append(n >= min_words and len(set(a).symmetric_difference(b)) <= 2 * most and within_edits(a, b, most))  # an edit changes two words at most
            yield batch.select(["c1", "c2"]).filter(pa.array(ok))

    return map_batches(both.select("c1", "c2", "x", "y"), run, "c1 long, c2 long").distinct()


def _close(less: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Whether lines of these numbers of words may be within the bound."""
    return more - less <= np.maximum(1, less // WORDS_PER_EDIT)


def _folded(words: np.ndarray, at: np.ndarray, size: int, few: int) -> np.ndarray:
    """``few`` parities of each text whose ``size`` begin at ``at``; twice as many are folded into one half."""
    own = words[at[:, None] + np.arange(few)]
    return own ^ words[at[:, None] + np.arange(few, 2 * few)] if size == 2 * few else own


def earliest_near(members: DataFrame) -> DataFrame:
    """(c1, c2, w1, w2, further): of lines, in each group, the earliest of its first ``HELD`` that lengths and parities do not keep apart.

    ``further`` tells of lines that may have more such lines; without one so far, ``w1`` is
    null. The members of a group stream through in their order, and no more than ``HELD`` are kept.
    """
    plain = ["key", "c1", "c2", "n", "doc_id", "line", *PARITY[:4]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            old = held.num_rows if held is not None else 0
            both = pa.concat_batches([held, batch]) if old else batch
            x = {c: both.column(c).to_numpy(zero_copy_only=False) for c in plain}
            size, words = both.column("more").value_lengths().to_numpy(zero_copy_only=False), both.column("more").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            begin = np.cumsum(size) - size
            bits = np.stack([x[p] for p in PARITY[:4]], axis=1).view(np.uint64)
            new = np.append(True, x["key"][1:] != x["key"][:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            rank = np.arange(len(new)) - start
            own = np.arange(old, len(new))
            count = np.minimum(rank[own], HELD)
            i = np.repeat(own, count)
            j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + start[i]
            bound = np.minimum(x["n"][i], x["n"][j]) // WORDS_PER_EDIT
            ok = (np.abs(x["n"][i] - x["n"][j]) <= bound) & ((x["doc_id"][j] < x["doc_id"][i]) | (x["line"][j] < x["line"][i]))
            i, j, bound = i[ok], j[ok], bound[ok]
            ok = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1) <= 2 * bound
            i, j, bound = i[ok], j[ok], bound[ok]
            ok = np.ones(len(i), bool)
            few = np.minimum(size[i], size[j])  # lines of about equal length have as many, or one has twice as many
            for a, b in np.unique(np.stack([size[i], size[j]], axis=1)[few > 0], axis=0).tolist():
                at = np.flatnonzero((size[i] == a) & (size[j] == b))
                apart = _folded(words, begin[i[at]], a, min(a, b)) ^ _folded(words, begin[j[at]], b, min(a, b))
                ok[at] = np.bitwise_count(apart).sum(axis=1) <= 2 * bound[at]
            i, j = i[ok], j[ok]
            near, first, times = np.unique(i, return_index=True, return_counts=True)
            beyond = rank >= HELD
            alone = np.setdiff1d(own[beyond[own]], near)
            line = np.concatenate([near, alone])
            w = pa.array(np.concatenate([j[first], alone]), mask=np.repeat([False, True], [len(near), len(alone)]))
            further = np.concatenate([(times > 1) | beyond[near], np.ones(len(alone), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(x["c1"][line]), pa.array(x["c2"][line]), both.column("c1").take(w), both.column("c2").take(w), pa.array(further)], ["c1", "c2", "w1", "w2", "further"])
            held = both.slice(int(start[-1]), min(HELD, len(new) - int(start[-1]))) if len(new) else held

    each = members.select(*plain, "more").repartition("key").sortWithinPartitions("key", "doc_id", "line")
    return map_batches(each, run, "c1 long, c2 long, w1 long, w2 long, further boolean")


def far_pairs(met: DataFrame) -> DataFrame:
    """(c1, c2, w1, w2): of lines and others, ``w``, that they meet, those that are earlier and that lengths and parities do not keep apart."""
    bound = F.floor(F.least("n", "w.n") / WORDS_PER_EDIT)
    differ = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"w.{p}"))) for p in PARITY[:4]), F.lit(0))
    few = F.least(F.size("more"), F.size("w.more"))  # lines of about equal length have as many, or one has twice as many

    def folded(c: str, i: Column) -> Column:
        return F.when(F.size(c) == few, F.get(c, i)).otherwise(F.get(c, i).bitwiseXOR(F.get(c, i + few)))

    apart = F.aggregate(F.sequence(F.lit(0), few - 1), F.lit(0), lambda n, i: n + F.bit_count(folded("more", i).bitwiseXOR(folded("w.more", i))))
    earlier = (F.col("w.doc_id") < F.col("doc_id")) | ((F.col("w.doc_id") == F.col("doc_id")) & (F.col("w.line") < F.col("line")))
    both = met.where(earlier & (F.abs(F.col("n") - F.col("w.n")) <= bound) & (differ <= 2 * bound) & F.when(few > 0, apart <= 2 * bound).otherwise(True))
    return both.select("c1", "c2", F.col("w.c1").alias("w1"), F.col("w.c2").alias("w2")).distinct()


def named(pairs: DataFrame) -> DataFrame:
    """(c1, c2) of all lines of the pairs."""
    return pairs.select("c1", "c2").union(pairs.select("w1", "w2")).distinct()


def of_pairs(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the lines of the pairs, which are few of those that meet."""
    return texts.join(small(cut(named(pairs), "lines")), ["c1", "c2"], "left_semi")


def edited_lines(docs: DataFrame, rows: DataFrame, lines: DataFrame, packed: DataFrame | None, min_words: int, drop: Callable[[], None] | None) -> DataFrame:
    """(c1, c2) of the lines within the bound of an earlier one; ``packed`` are the keys of the longer lines, which ``drop`` removes after use."""
    if packed is None:
        some = F.col("n") >= min_words
        texts = cut(line_texts(docs, lines.where(some).join(half_sharers(rows.where(some), min_words), "c1")), "lines")
        return verified(meetings(variants(texts)), texts, min_words)
    met = cut(meet(packed, _close).withColumnRenamed("id", "c1"), "lines")
    drop()
    short = F.col("n") <= FAR_WORDS  # longer lines meet by runs
    wanted = lines.where(F.col("n") >= min_words).join(met.select("c1").distinct().hint("shuffle_hash"), "c1", "left_semi")
    long, near, _ = cut_apart(line_texts(docs, wanted.withColumns({"head": short, "tail": short}), True), "lines", "head")
    texts = long.union(near)
    groups, signs = met, texts.where(F.col("n") >= FAR_WORDS).select("c1", "c2", "n", "doc_id", "line", *PARITY)
    members = groups.join(signs.hint("shuffle_hash"), "c1")
    tried = cut(earliest_near(members).groupBy("c1", "c2", "w1", "w2").agg(F.max("further").alias("further")), "lines")
    met = cut(meetings(variants(near.withColumn("head", F.lit(True)))).union(tried.where("w1 is not null").drop("further")), "lines")
    settled = cut(verified(met, cut(of_pairs(texts, met), "lines"), min_words, True), "lines")
    left = cut(tried.where("further").select("c1", "c2").distinct().join(settled, ["c1", "c2"], "left_anti"), "lines")
    if left.isEmpty():
        return settled
    theirs = cut(groups.join(small(left.select("c1").distinct()), "c1", "left_semi").select("key").distinct(), "lines")
    some = cut(groups.join(small(theirs), "key", "left_semi"), "lines")
    members = cut(some.join(signs.join(small(cut(some.select("c1").distinct(), "lines")), "c1", "left_semi").hint("shuffle_hash"), "c1"), "lines")
    whole = F.struct("doc_id", "line", "c1", "c2", "n", *PARITY).alias("w")
    rest = cut(far_pairs(members.join(small(left), ["c1", "c2"], "left_semi").join(members.select("key", whole), "key")).join(tried, ["c1", "c2", "w1", "w2"], "left_anti"), "lines")
    return settled.union(verified(rest, cut(of_pairs(texts, rest), "lines"), min_words, True))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_edits: int | None = None) -> DataFrame:
    """(doc_id, gone): for each document, the numbers and content hashes of lines that an earlier document settles.

    ``max_edits`` is 0 or 1 for a bound that does not grow with the line.
    """
    if max_edits not in (None, 0, 1):
        raise ValueError("max_edits must be None, 0 or 1")
    with temporary(docs.sparkSession):
        return _repeated_lines(docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text"), min_words, max_edits)


def _repeated_lines(docs: DataFrame, min_words: int, max_edits: int | None) -> DataFrame:
    far = max_edits is None
    if far:
        rows, packed, drop = cut_apart(line_rows(docs, True, min_words).withColumn("far", F.col("bucket").isNotNull()), "lines", "far")
        rows = rows.drop("bucket", "cells")
    else:
        rows, packed, drop = cut(line_rows(docs), "lines"), None, None
    lines = cut(distinct_lines(rows), "lines")
    first = lines.select("c1", "c2", F.col("doc_id").alias("least"), "places")
    if max_edits != 0:
        edited = cut(edited_lines(docs, rows, lines, packed, min_words, drop).distinct(), "lines")
        first = first.join(edited.withColumn("edited", F.lit(True)).hint("shuffle_hash"), ["c1", "c2"], "left")
    else:
        first = first.withColumn("edited", F.lit(None).cast("boolean"))
    first = first.where("edited or places > 1").drop("places")  # other lines stay
    met = split_join(rows.select("c1", "c2", "doc_id", "line"), first, ["c1", "c2"], hot_keys(lines, ["c1", "c2"], "places"), ["doc_id"]).where(F.col("edited") | (F.col("doc_id") > F.col("least")))
    return cut(met.groupBy("doc_id").agg(F.collect_list(F.struct("line", "c1")).alias("gone")), "lines", keep=True)


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_edits: int | None = None, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """``docs`` with repeated lines cut from ``text``, and two counts of lines with a word: ``n_lines`` and ``n_removed``.

    The counts replace columns of their names; every other column passes through.
    """
    gone = repeated_lines(docs, min_words, max_edits)
    (own,) = unused(docs, "gone")
    both = docs.drop(n_lines, n_removed).join(gone.withColumnRenamed("gone", own).hint("shuffle_hash"), "doc_id", "left")
    fields = [f for f in both.schema.fields if f.name != own]
    schema = T.StructType([*fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                texts = batch.column("text").to_pylist()
                known = batch.column("doc_id").is_valid().to_pylist()
                size = batch.column(own).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                gone = batch.column(own).flatten()
                number, content = (gone.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                odd = pc.match_substring_regex(batch.column("text"), _ODD_SPACE).fill_null(False).to_pylist()
                lines = [(text or "").encode("utf-8").split(b"\n") for text in texts]
                lines = [[b" ".join(x.split()) for x in own_lines] if yes else own_lines for own_lines, yes in zip(lines, odd, strict=True)]
                # The words of the lines gone. They stand at their numbers, but where other rows share the id.
                ends = np.cumsum(size).tolist()
                words: list[bytes] = []
                for own_lines, k, end in zip(lines, size.tolist(), ends, strict=True):
                    words += [own_lines[i] if i < len(own_lines) else b"" for i in number[end - k : end].tolist()]
                other = _contents(words) != content
                total, lost, new = [], [], list(texts)
                for k, own_lines in enumerate(lines):
                    mine = slice(ends[k] - size[k], ends[k])
                    total.append(len(own_lines) - own_lines.count(b""))
                    if not known[k] or not size[k] and len({*own_lines, b""}) == total[-1] + 1:  # nothing to drop, and no line twice
                        lost.append(0)
                        continue
                    drop = set(words[mine])
                    if other[mine].any():
                        drop = {x for x, yes in zip(own_lines, np.isin(_contents(own_lines), content[mine]).tolist(), strict=True) if yes}
                    drop.discard(b"")
                    stay, seen = [], set(drop)
                    for i, x in enumerate(own_lines):
                        if x not in seen:
                            stay.append(i)
                            if x:  # repeats inside a document: all but the first place
                                seen.add(x)
                    lost.append(len(own_lines) - len(stay))
                    if lost[-1]:
                        raw = texts[k].split("\n")
                        new[k] = "\n".join([raw[i] for i in stay])
                out = pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if f.name == "text" else batch.column(f.name) for f in fields], [f.name for f in fields])
                yield with_column(with_column(out, n_lines, pa.array(total, pa.int64())), n_removed, pa.array(lost, pa.int64()))

    return map_batches(both, run, schema)
