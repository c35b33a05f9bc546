"""Toxicity: a linear classifier over words, regularised by counterfactuals.

Features are the distinct lower-cased words of a text and their prefixes of 4
and 6 letters (identity terms have no prefixes), hashed to ``BUCKETS``. The
logistic loss carries an L1 term and a counterfactual term: in each labelled
text, its identity terms are swapped for others of the list and for neutral
words, or, if it has none, a neutral word is swapped for an identity term; the
squared change of the score (before the logistic function) is penalised, so that
the mere mention of a group does not move the score.

The fit uses a bounded sample of labelled rows (``max_rows``, the smallest
hashes of their ids; one document each, of which a set of features reaches the
driver); scoring covers every whole text. Null and empty texts have
no features and get the intercept's score. Several labels of one id count as
their maximum; labels without a document, or null, are left out. Without two
classes in the sample every score is the base rate (0 if there are no labels).
Other columns pass through; ``score`` replaces one of that name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches, release
from chunksink.llm.bpe import slices, with_column

BUCKETS = 1 << 20
MAX_ROWS = 12_000
#: Features of the sample that a step of the fit looks at together.
FIT_PART = 1 << 18
MEMO_ENTRIES = 150_000
THRESHOLD = 0.3

# Terms that name groups of people, in the languages of the corpus.
IDENTITY_TERMS = [
    "muslim", "muslims", "jewish", "jews", "christian", "christians", "hindu", "buddhist", "atheist", "catholic", "black", "white", "asian", "african",
    "latino", "hispanic", "arab", "immigrant", "immigrants", "refugee", "refugees", "gay", "lesbian", "bisexual", "transgender", "queer", "straight",
    "woman", "women", "man", "men", "female", "male", "disabled", "deaf", "blind", "old", "young", "american", "mexican", "chinese", "indian", "european",
    "muslime", "jude", "juden", "christ", "christen", "schwarze", "weiße", "araber", "ausländer", "flüchtling", "flüchtlinge", "frau", "frauen", "mann", "männer", "behinderte", "alte", "junge", "türke", "türken",
    "musulman", "musulmans", "juif", "juifs", "chrétien", "chrétiens", "noir", "noirs", "blanc", "blancs", "arabe", "arabes", "étranger", "étrangers", "réfugié", "femme", "femmes", "homme", "hommes", "vieux", "jeune", "africain",
    "musulmán", "musulmanes", "judío", "judíos", "cristiano", "cristianos", "negro", "negros", "blanco", "blancos", "árabe", "árabes", "extranjero", "extranjeros", "refugiado", "mujer", "mujeres", "hombre", "hombres", "viejo", "joven",
]

_IDENTITY = frozenset(IDENTITY_TERMS)
_WORDS = re.compile(r"[^\W\d_]+")


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8")) % BUCKETS


def identity_buckets() -> np.ndarray:
    return np.unique([_bucket(w) for w in IDENTITY_TERMS])


class _Features:
    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct buckets of a text."""
        if not text:
            return np.zeros(0, np.int64)
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        out: set[int] = set()
        memo = self.memo
        for w in set(_WORDS.findall(text.lower())):
            hit = memo.get(w)
            if hit is None:
                hit = memo[w] = (_bucket(w),) if w in _IDENTITY else (_bucket(w), *(_bucket(f"{w[:k]}*") for k in (4, 6) if len(w) > k))
            out.update(hit)
        return np.sort(np.fromiter(out, np.int64, len(out)))


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, features: np.ndarray) -> float:
        z = self.intercept + float(self.weights[features].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _swaps(doc: np.ndarray, cols: np.ndarray, seen: np.ndarray, named: np.ndarray, neutral: np.ndarray, swaps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features out and in of the counterfactual sentences, and the weight of what comes in: 0 for a neutral word, else 1.

    A sentence with identity terms has each of them swapped, for another or, every
    second time, for a neutral word. One without has an identity term put in the
    place of its most frequent word that toxic texts hold no more often.
    """
    names = np.zeros(len(neutral), bool)
    names[named] = True
    is_named = names[cols]
    has = np.zeros(int(doc.max()) + 1 if len(doc) else 0, bool)
    has[doc[is_named]] = True
    place = np.empty(len(neutral), np.int64)  # of the features from the most frequent down, equal ones in their order
    by_place = np.lexsort((np.arange(len(neutral)), -seen))
    place[by_place] = np.arange(len(neutral))
    least = np.full(len(has), len(neutral), np.int64)
    for a in range(0, len(doc), FIT_PART):
        of, own = doc[a : a + FIT_PART], cols[a : a + FIT_PART]
        plain = ~has[of] & neutral[own]
        np.minimum.at(least, of[plain], place[own[plain]])
    mentions = int(is_named.sum()) * swaps
    out = np.concatenate([np.repeat(cols[is_named], swaps), by_place[least[least < len(neutral)]]])
    into = named[np.random.default_rng(0).integers(0, len(named), len(out))]
    return out, into, (np.arange(len(out)) % 2 == 1) | (np.arange(len(out)) >= mentions)


def fit(rows: list[np.ndarray], labels: np.ndarray, l1: float = 4e-4, counterfactual: float = 1.0, swaps: int = 8, steps: int = 150, least_rows: int = 3) -> Model:
    """Fit by proximal adaptive gradient steps; ``counterfactual`` weighs the squared score changes of identity swaps.

    Features are scaled by the logarithm of the ratio of their rates in the two classes.
    """
    weights = np.zeros(BUCKETS)
    n = len(rows)
    y = np.asarray(labels, float)
    rate = float(y.mean()) if n else 0.0
    if not 0 < rate < 1:
        return Model(weights, 50.0 if rate else -50.0)
    seen = np.zeros(BUCKETS, np.int64)
    for r in rows:  # distinct buckets
        seen[r] += 1
    named = identity_buckets()
    used = (seen >= least_rows) & (seen <= 0.5 * n)
    used[named] = True
    index = (np.cumsum(used) - 1).astype(np.int32)
    kept = [index[r[used[r]]] for r in rows]
    lens = np.array([len(r) for r in kept])
    ends = np.append(0, np.cumsum(lens))
    cols = np.concatenate(kept)
    del kept
    doc = np.repeat(np.arange(n, dtype=np.int32), lens)
    p = int(used.sum())
    cuts = [0, *(np.flatnonzero(np.diff(ends[:-1] // FIT_PART)) + 1).tolist(), n]
    parts = [(a, b, doc[ends[a] : ends[b]] - np.int32(a), cols[ends[a] : ends[b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
    toxic = sum((np.bincount(own[y[a:b][of] > 0], minlength=p) for a, b, of, own in parts), np.zeros(p, np.int64))
    other = seen[used] - toxic
    scale = np.log((toxic + 1) / (y.sum() + 2)) - np.log((other + 1) / (n - y.sum() + 2))
    scale /= np.sqrt((scale**2).mean()) or 1.0
    swap_out, swap_in, counts = _swaps(doc, cols, toxic + other, index[named], scale <= 0, swaps)
    del doc
    w, b = np.zeros(p), float(np.log(rate / (1 - rate)))
    grown, grown_b = np.full(p, 1e-8), 1e-8
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for _ in range(steps):
        u = scale * w
        g, err = np.zeros(p), np.zeros(n)
        for start, stop, of, own in parts:  # so that nothing of the size of the sample is made at each step
            s = sigmoid(b + np.bincount(of, u[own], stop - start))
            err[start:stop] = (s - y[start:stop]) / n
            g += np.bincount(own, err[start:stop][of], p)
        g_b = float(err.sum())
        if counterfactual and len(swap_out):
            change = 2 * counterfactual * (u[swap_out] - counts * u[swap_in]) / len(swap_out)
            g += np.bincount(swap_out, change, p) - np.bincount(swap_in, counts * change, p)
        g *= scale
        grown += g * g
        grown_b += g_b * g_b
        rate_w = 0.3 / np.sqrt(grown)
        w = w - rate_w * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate_w * l1, 0)
        b -= 0.3 / np.sqrt(grown_b) * g_b
    weights[np.flatnonzero(used)] = scale * w
    return Model(weights, b)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS, **settings: float) -> Model:
    """Fit on at most ``max_rows`` labelled documents, one a labelled id: of rows that share it, the text with the least hash."""
    wanted = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(doc_id).agg((F.max(label) > 0).cast("int").alias("_y"))
    wanted = wanted.orderBy(F.xxhash64(doc_id), doc_id).limit(max_rows)  # bounded, so it may be broadcast
    held = docs.select(F.col(doc_id).alias("_id"), F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("t")).alias("_t")).join(F.broadcast(wanted.withColumnRenamed(doc_id, "_id")), "_id")
    chosen = held.groupBy("_id").agg(F.max("_y").alias("_y"), F.min("_t").alias("_t")).select("_y", F.col("_t.t").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features()
        for whole in batches:
            for batch in slices(whole, text):
                found = [features.of(t) for t in batch.column(text).to_pylist()]
                key = [zlib.crc32(f.tobytes()) for f in found]
                yield pa.RecordBatch.from_arrays([batch.column("_y").cast(pa.int32()), pa.array(key, pa.int64()), pa.array([f.astype("<i4").tobytes() for f in found], pa.binary())], ["y", "key", "features"])

    found = map_batches(chosen, run, "y int, key long, features binary")
    got = sorted(((r["key"], r["y"], np.frombuffer(r["features"], "<i4")) for r in found.collect()), key=lambda r: r[:2])
    try:
        return fit([r[2] for r in got], np.array([r[1] for r in got]), **settings)
    finally:
        got.clear()
        release()


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, between 0 and 1."""
    held = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(model.weights).astype(np.int32), model.weights[model.weights != 0], model.intercept))
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != out), T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, intercept = held.value
        weights = np.zeros(BUCKETS)
        weights[at] = values
        own, features = Model(weights, intercept), _Features()
        for whole in batches:
            for batch in slices(whole, text):
                yield with_column(batch, out, pa.array([own.score(features.of(t)) for t in batch.column(text).to_pylist()], pa.float64()))

    return map_batches(docs, run, schema)


def training_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels that may be learned from: those whose hashed id does not fall into the held-out quarter."""
    return labels.where(~held_out(doc_id))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
