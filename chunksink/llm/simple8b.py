"""Simple-8b word-aligned coding of token ids, and files of encoded documents.

A 64-bit word holds a 4-bit selector and 60 bits of payload: selector ``s``
packs ``COUNTS[s]`` values of ``BITS[s]`` bits each. A value of more than 60 bits
is an escape: a word with selector 15, then the raw value. Values are cut into
blocks of ``BLOCK`` that start on a word, and the offset of each block is kept,
so that blocks decode at once.

``write_ids`` writes files in ascending id order; ``read_ids`` returns one row a
document from the files. Null ids of documents come first and keep their rows;
repeated ids keep one row each; null or empty texts get the end id alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches
from chunksink.llm.bpe import slices

# Fixed values of the code: selector 0 to 13.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
BLOCK = 1024
MAGIC = b"S8BIDS01"
FILE_IDS = 4_000_000
#: Values packed or unpacked at once.
PIECE = 256 * BLOCK
MEMO_ENTRIES = 1_000_000


_WIDTHS = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    if len(values) and int(values.max()) < 1 << 16:
        return _WIDTHS[values]
    return np.searchsorted(np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)), values, side="right").astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``values``, and the word offset of each block."""
    words, offsets, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for k in range(0, len(values), PIECE):
        w, o = _pack(np.asarray(values[k : k + PIECE], np.uint64))
        words.append(w)
        offsets.append(o + at)
        at += len(w)
    return np.concatenate(words), np.concatenate(offsets)


def _pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, blocks = len(values), -(-len(values) // BLOCK)
    pad = int(COUNTS[0])
    v = np.zeros((blocks, BLOCK + pad), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = values
    v[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    w = _widths(v.ravel()).reshape(v.shape)
    choose = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    widest, span = w, 1
    for s in range(len(COUNTS) - 1, -1, -1):  # the largest count that fits wins
        while span < COUNTS[s]:
            step = min(span, int(COUNTS[s]) - span)
            grown = widest.copy()
            grown[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            widest, span = grown, span + step
        np.copyto(choose, np.uint8(s), where=widest[:, :BLOCK] <= np.uint8(BITS[s]))
    size = np.ones(ESCAPE + 1, np.int64)
    size[: len(COUNTS)] = COUNTS
    starts = np.zeros((blocks, BLOCK), bool)
    length = np.full(blocks, BLOCK)
    length[-1] = n - (blocks - 1) * BLOCK
    lane, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(lane):
        starts[lane, at] = True
        at = at + size[choose[lane, at]]
        more = at < length[lane]
        lane, at = lane[more], at[more]
    row, col = np.nonzero(starts)
    sel = choose[row, col]
    cells = np.where(sel == ESCAPE, 2, 1)
    place = np.cumsum(cells) - cells
    words = np.zeros(int(cells.sum()), np.uint64)
    stride = BLOCK + pad
    v = v.ravel()
    for s in np.unique(sel).tolist():
        own = sel == s
        first, out = row[own] * stride + col[own], place[own]
        if s == ESCAPE:
            words[out], words[out + 1] = np.uint64(ESCAPE << 60), v[first]
            continue
        word = np.full(len(first), np.uint64(s << 60))
        for j in range(int(COUNTS[s])):
            word |= v[first + j] << np.uint64(j * int(BITS[s]))
        words[out] = word
    return words, place[np.searchsorted(row, np.arange(blocks))]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, kind: type = np.uint64) -> np.ndarray:
    """The ``n`` values of packed ``words``; many blocks decode together."""
    out, step = np.zeros(n, kind), PIECE // BLOCK
    ends = np.append(offsets, len(words))
    for k in range(0, len(offsets), step):
        last = min(k + step, len(offsets))
        part = out[k * BLOCK : last * BLOCK]
        part[:] = _unpack(words[ends[k] : ends[last]], offsets[k:last] - offsets[k], len(part))
    return out


def _unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    taken = -1
    for i in np.flatnonzero(sel == ESCAPE).tolist():
        if i != taken:
            taken = i + 1
            raw[taken] = True
    head = np.flatnonzero(~raw)
    sel = sel[head]
    count = np.where(sel == ESCAPE, 1, COUNTS[np.minimum(sel, len(COUNTS) - 1)])
    before = np.cumsum(count) - count
    first = np.searchsorted(head, offsets)  # first packed word of each block
    block = np.searchsorted(first, np.arange(len(head)), side="right") - 1
    inside = before - before[first][block]
    length = np.full(len(offsets), BLOCK)
    length[-1] = n - (len(offsets) - 1) * BLOCK
    count = np.minimum(count, length[block] - inside)
    begin = np.cumsum(count) - count
    which = np.repeat(np.arange(len(head)), count)
    slot = (np.arange(int(count.sum())) - begin[which]).astype(np.uint64)
    s = sel[which]
    bits = BITS[np.minimum(s, len(BITS) - 1)].astype(np.uint64)
    word = words[head][which]
    out = (word >> (slot * bits)) & ((np.uint64(1) << bits) - np.uint64(1))
    big = s == ESCAPE
    if big.any():
        out[big] = words[head[which[big]] + 1]
    return out


def dump(doc_ids: list[int | None], lengths: np.ndarray, values: np.ndarray) -> bytes:
    """One file: header, document ids with a validity byte each, lengths, block offsets, words."""
    words, offsets = pack(values)
    return b"".join(
        [
            MAGIC,
            struct.pack("<4q", len(doc_ids), len(values), len(offsets), len(words)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.asarray(lengths, "<i8").tobytes(),
            offsets.astype("<i8").tobytes(),
            words.astype("<u8").tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        ]
    )


def parse(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all values of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token-id file")
    docs, n, blocks, n_words = struct.unpack_from("<4q", data, 8)
    at, parts = 40, []
    for kind, k in (("<i8", docs), ("<i8", docs), ("<i8", blocks), ("<u8", n_words), ("u1", docs)):
        parts.append(np.frombuffer(data, kind, k, at))
        at += parts[-1].nbytes
    ids, lengths, offsets, words, valid = parts
    return [i if ok else None for i, ok in zip(ids.tolist(), valid.tolist(), strict=True)], lengths, unpack(words, offsets, n, np.uint32)


# Anything but common letters, marks and white space, about which regular expression engines agree; or a special token.
_ODD = "[^\t-\r\x20-\x7e\xa1-ɏЀ-џぁ-ゖァ-ヺ一-龥–—‘-„•…€]|<\\|"
#: The pre-tokens of the vocabulary (fixed value).
_PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_TOKENIZERS: dict = {}


class _Memo:
    """Ids of strings: a number for each string, and where its ids lie in one array."""

    def __init__(self) -> None:
        self.of: dict[str, int] = {}
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def add(self, names: list[str], size: np.ndarray, ids: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, np.cumsum(size) - size + len(self.ids)])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        self.of.update(zip(names, range(len(self.of), len(self.of) + len(names)), strict=True))

    def find(self, names: Iterable[str], n: int) -> np.ndarray:
        """Numbers of ``n`` strings, -1 for those not known."""
        return np.fromiter(map(self.of.get, names, repeat(-1)), np.int64, n)

    def gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known strings by their numbers, one after the other, and the count of each."""
        size = self.size[slot]
        shift = self.begin[slot] - (np.cumsum(size) - size)
        return self.ids[np.arange(int(size.sum())) + np.repeat(shift, size)], size


def _per(group: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of ``size`` over consecutive groups of ``group`` members each."""
    total = np.append(0, np.cumsum(size))
    ends = np.cumsum(group)
    return total[ends] - total[ends - group]


class _Words:
    """The tokenizer with bounded memos of words and of their pre-tokens.

    A text in NFC without odd characters splits at white space, its words into
    lower-cased pre-tokens that encode one by one; any other text goes to the
    tokenizer whole. The memos only save time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.parts = _Memo(), _Memo()
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn_parts(self, parts: list[str]) -> None:
        """Encode new pre-tokens, many as one text: each ends with its only token that closes a word."""
        for at in range(0, len(parts), 5000):
            piece = parts[at : at + 5000]
            ids = self._ids(" ".join(piece))
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(piece) or ends[-1] != len(ids):
                each = [self._ids(p) for p in piece]
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            self.parts.add(piece, np.diff(ends, prepend=0), ids)

    def _learn_words(self, words: list[str]) -> None:
        cut = [[w] if w.isalpha() else [w[:-1], w[-1]] if w[-1] in ".,;:!?" and w[:-1].isalpha() else _PRE_TOKENS.findall(w) for w in map(str.lower, words)]
        self._learn_parts(list(set(chain.from_iterable(cut)).difference(self.parts.of)))
        group = np.fromiter(map(len, cut), np.int64, len(cut))
        ids, size = self.parts.gather(self.parts.find(chain.from_iterable(cut), int(group.sum())))
        self.words.add(words, _per(group, size), ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and the count of each."""
        if len(self.words.of) > MEMO_ENTRIES:
            self.words = _Memo()
        if len(self.parts.of) > MEMO_ENTRIES:
            self.parts = _Memo()
        cells = pa.array([t or "" for t in texts], pa.large_string())
        odd = pc.match_substring_regex(cells, _ODD).to_numpy(zero_copy_only=False)
        plain = [not x and is_normalized("NFC", t or "") for t, x in zip(texts, odd.tolist(), strict=True)]
        if not all(plain):
            cells = pc.if_else(pa.array(plain, pa.bool_()), cells, pa.scalar("", pa.large_string()))
        split = pc.ascii_split_whitespace(cells)  # an empty word stands where white space begins or ends a text
        words = split.flatten()
        some = pc.not_equal(words, "")
        before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
        group = np.diff(before[np.append(0, np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False)))])
        coded = words.filter(some).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slot = self.words.find(names, len(names))
        new = np.flatnonzero(slot < 0)
        first = len(self.words.of)
        self._learn_words([names[k] for k in new.tolist()])
        slot[new] = np.arange(first, first + len(new))
        ids, size = self.words.gather(slot[coded.indices.to_numpy()])
        size = _per(group, size)
        whole = {k: self._ids(t) for k, (t, ok) in enumerate(zip(texts, plain, strict=True)) if t and not ok}
        if whole:
            cells = np.split(ids, np.cumsum(size)[:-1])
            cells = [whole.get(k, x) for k, x in enumerate(cells)]
            ids, size = np.concatenate(cells), np.fromiter(map(len, cells), np.int64, len(cells))
        return ids, size


def _words(path: str) -> _Words:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _Words(path)
    return _TOKENIZERS[path]


def _save(folder: str, name: str, data: bytes) -> None:
    """Write once whole: a retried task replaces its own file."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/_{name}.part") as f:
        f.write(data)
    store.move(f"{base}/_{name}.part", f"{base}/{name}")


MANIFEST = "file string, part long, seq long, n_docs long, n_ids long"


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode each text, append ``end_id`` and write the files below ``folder`` in ascending order of ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        values: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            name = f"ids-{part:06d}-{seq:06d}.s8b"
            _save(folder, name, dump(ids, np.concatenate(lengths), np.concatenate(values)))
            return pa.RecordBatch.from_pylist([{"file": name, "part": part, "seq": seq, "n_docs": len(ids), "n_ids": size}])

        for whole in batches:
            for batch in slices(whole, text, 1 << 21):
                found, count = _words(vocabulary).encode(batch.column(text).to_pylist())
                ids += batch.column(doc_id).to_pylist()
                lengths.append(count + 1)
                values.append(np.insert(found, np.cumsum(count), end_id))
                size += len(values[-1])
                if size >= FILE_IDS:
                    yield flush()
                    seq, size, ids, lengths, values = seq + 1, 0, [], [], []
        if ids:
            yield flush()

    ordered = docs.select(doc_id, text).repartitionByRange(F.col(doc_id)).sortWithinPartitions(doc_id)
    map_batches(ordered, run, MANIFEST).write.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document of the files: ``doc_id``, ``start`` (ids before it) and ``ids`` (unsigned 32-bit, little-endian)."""
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("at", T.LongType()), T.StructField("ids", T.BinaryType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content"), strict=True):
                ids, lengths, values = parse(data.as_py())
                flat, ends = values.astype("<u4", copy=False).tobytes(), np.cumsum(lengths)
                at = ends - lengths
                cells = [flat[4 * a : 4 * b] for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
                for k in range(0, len(ids), 2000):
                    part = slice(k, k + 2000)
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py().rsplit("/", 1)[1]] * len(ids[part])), pa.array(ids[part], pa.int64()), pa.array(at[part]), pa.array(cells[part], pa.binary())], names)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(folder).select("path", "content")
    return map_batches(files, run, schema).join(offsets, "file").select("doc_id", (F.col("at") + F.col("offset")).alias("start"), "ids")
