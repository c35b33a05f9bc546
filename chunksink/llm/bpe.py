"""Byte-level BPE encoding and decoding.

``encode`` appends the token ids of every whole text as little-endian unsigned
32-bit integers (one binary value a document), ``decode`` turns such a column
back into text. Null texts count as empty and give no ids. Rows are handled one
by one, so ties, repeats and extra columns need no rule; the output column
replaces one of the same name.

Distinct pre-tokens of a batch are merged together: an index maps every
adjacent pair to its positions, ranks that occur are applied in ascending order
and each merge updates the lists of its neighbours. Finished pre-tokens are kept
in a bounded memo of the Python worker, which only saves time.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches

MEMO_ENTRIES = 150_000
SLICE_BYTES = 1 << 20
#: The pre-tokenisation pattern of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteBPE:
    """A vocabulary with merges, read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        self.first = np.array([vocab[c] for c in symbols], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in s)
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        #: By rank: both sides and the result.
        self.pairs: list[tuple[int, int, int]] = []
        for m in spec["model"]["merges"]:
            x, y = m.split(" ") if isinstance(m, str) else m
            self.pairs.append((vocab[x], vocab[y], vocab[x + y]))
        table = np.array(self.pairs, np.int64).reshape(-1, 3)
        keys = table[:, 0] * len(self.bytes_of) + table[:, 1]
        self.key_rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.key_rank]
        lowest: dict[int, int] = {}
        for r, (x, y, _) in enumerate(self.pairs):
            lowest.setdefault(x, r)
            lowest.setdefault(y, r)
        #: Ranks whose result also stands in a pair of lower rank: applied one place a word at a time.
        self.early = {r for r, (_, _, new) in enumerate(self.pairs) if lowest.get(new, r) < r}
        self.words = regex.compile(PATTERN)
        self.stops = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """Pre-tokens in order; special strings stay whole."""
        if self.stops is None or not self.stops.search(text):
            return self.words.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.stops.split(text)):
            if k % 2:
                out.append(part)
            elif part:
                out += self.words.findall(part)
        return out

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (a[i], b[i]), -1 where it is none."""
        key = a.astype(np.int64) * len(self.bytes_of) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.key_rank[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (little-endian unsigned 32-bit), all words merged over one pair index."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = int(lengths.sum()) + len(words)
        last = np.cumsum(lengths + 1) - 1  # the gap after each word holds -1, which pairs with nothing
        ids = np.full(n, -1, np.int32)
        inside = np.ones(n, bool)
        inside[last] = False
        ids[inside] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths + 1)
        left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(a: np.ndarray, b: np.ndarray) -> None:
            ranks = self.ranks_of(ids[a], ids[b])
            hit = np.flatnonzero(ranks >= 0)
            if not len(hit):
                return
            hit = hit[np.argsort(ranks[hit], kind="stable")]
            ranks = ranks[hit]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, places in zip(ranks[np.r_[0, cuts]].tolist(), np.split(a[hit], cuts), strict=True):
                if r in index:
                    index[r].append(places)
                else:
                    index[r] = [places]
                    heapq.heappush(queue, r)

        note(np.arange(n - 1), np.arange(1, n))
        while queue:
            r = heapq.heappop(queue)
            found = index.pop(r)
            a = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            first, second, new = self.pairs[r]
            a = a[ids[a] == first]
            b = right[a]
            live = ids[b] == second
            a, b = a[live], b[live]
            if first == second and len(a) > 1:  # in a run of equal ids, every other place from the left
                keep, used = [], -1
                for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    if x != used:
                        keep.append(k)
                        used = y
                a, b = a[keep], b[keep]
            if r in self.early and len(a):
                _, one = np.unique(word[a], return_index=True)
                rest = np.delete(a, one)
                a, b = a[one], b[one]
                if len(rest):
                    index[r] = [rest]
                    heapq.heappush(queue, r)
            if not len(a):
                continue
            after = right[b]
            ids[a], ids[b] = new, -2
            right[a], left[after] = after, a
            before = left[a]
            ok = before >= 0
            note(np.concatenate([before[ok], a]), np.concatenate([a[ok], after]))
        alive = ids >= 0
        count = np.bincount(word[alive], minlength=len(words))
        flat, ends = ids[alive].astype("<u4").tobytes(), np.cumsum(count) * 4
        return [flat[e - 4 * c : e] for e, c in zip(ends.tolist(), count.tolist(), strict=True)]

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        split = [self.split(t) if t else [] for t in texts]
        missing = list({w for words in split for w in words if w not in memo})
        ordinary = [w for w in missing if w not in self.special]
        memo.update((w, self.special[w].to_bytes(4, "little")) for w in missing if w in self.special)
        if ordinary:
            memo.update(zip(ordinary, self.merge([w.encode() for w in ordinary]), strict=True))
        return [b"".join(map(memo.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """The vocabulary at ``path``, read once a process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """``batch`` cut so that ``column`` holds about ``most`` bytes a piece (one row at least)."""
    start, size = 0, 0
    for i, v in enumerate(batch.column(column)):
        n = len(v.as_buffer()) if v.is_valid else 0
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), values], [*keep, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the encoded whole text, and ``decoded``, if named: the text that these ids decode to.

    Naming ``decoded`` spares a second Python worker beside each task.
    """
    schema = _schema(docs, ids, T.BinaryType())
    if decoded:
        schema = T.StructType([*(f for f in schema.fields if f.name != decoded), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for whole in batches:
            for batch in slices(whole, text, SLICE_BYTES):
                coded = bpe.encode_batch(batch.column(text).to_pylist())
                out = with_column(batch, ids, pa.array(coded, pa.binary()))
                yield with_column(out, decoded, pa.array([bpe.decode(x) for x in coded], pa.string())) if decoded else out

    return map_batches(docs, run, schema)


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with ``text``, decoded from ``ids``; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for whole in batches:
            for batch in slices(whole, ids):
                yield with_column(batch, text, pa.array([bpe.decode(x or b"") for x in batch.column(ids).to_pylist()], pa.string()))

    return map_batches(docs, run, _schema(docs, text, T.StringType()))
