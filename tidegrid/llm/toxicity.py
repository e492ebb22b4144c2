"""Toxicity by compression distance: each word of a text is compressed with two zstandard dictionaries.

One dictionary is trained on words of toxic texts, one on words of ordinary texts. A window is one word between a
constant pad and a space: in longer windows the few bytes that a known word saves drown in what the rest happens
to match, and without the pad the window is too short to be compressed at all. Its margin is the length under
the ordinary dictionary less that under the toxic one. A document is described by its largest margin and by how
many of its windows reach each of ``THRESHOLDS``; a logistic curve fitted on other training documents calibrates
these into a score.

Words count for a class by the number of different words that they follow, so that copies of a text count once.

Fitting reads at most ``TRAIN_DOCS`` + ``CALIBRATION_DOCS`` labelled texts of each class, the first by a hash of the
id, none over ``TRAIN_BYTES``. Scoring reads every text whole. Ids and labels never enter a score.

Defined cases: null and wordless texts have no margins and get the curve's value for none; without labelled texts
of both classes every score is 0; rows whose labels disagree count as toxic; rows are scored one by one, so
repeated rows and null ids stay, the latter not held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import LOWER, Words, flat, slices

TRAIN_DOCS = 1_500
CALIBRATION_DOCS = 750
TRAIN_BYTES = 20_000
DICTIONARY_BYTES = 4_096
LEVEL = 12
# A word is typical of a class if it follows so many words there, and is so many times as frequent as in the other.
CONTEXTS, RATIO = 5, 8.0
THRESHOLDS = (2, 3, 4, 5, 6, 8)
PAD = b"." * 16
# Distinct words whose margins a task remembers.
KNOWN = 150_000
# Letters, and every byte of a sign beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[97:123] = IS_WORD[128:] = True


def _words(texts: list[str | None]) -> Words:
    data, bounds = flat(pa.array(texts, pa.string()))
    return Words(LOWER[data], bounds, IS_WORD)


def _framed(words: list[bytes]) -> list[bytes]:
    return [PAD + b" " + word + b" " for word in words]


def _dictionary(samples: list[bytes]) -> bytes:
    """Trained on the samples; their own bytes if they are too few to train on.

    The trainer takes its best segment from each stretch of the samples, so their order must mix the words.
    """
    samples = [samples[i] for i in np.random.default_rng(1).permutation(len(samples))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=24, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:].rjust(8, b".")


class Model:
    """Two dictionaries and a curve. Pickles as bytes and numbers; compressors are made where it is used."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.dictionaries = toxic, ordinary
        self.curve: np.ndarray | None = None
        self.known: dict[bytes, int] = {}
        self.compressors = None

    def __getstate__(self):
        return self.dictionaries, self.curve

    def __setstate__(self, state):
        self.dictionaries, self.curve = state
        self.known, self.compressors = {}, None

    def fresh(self) -> Model:
        """The same model without what it has met: a broadcast one would keep it as long as its worker lives."""
        model = Model(*self.dictionaries)
        model.curve = self.curve
        return model

    def _lengths(self, which: int, joined: bytes, segments: bytes) -> np.ndarray:
        if self.compressors is None:
            self.compressors = []
            for content in self.dictionaries:
                dictionary = zstandard.ZstdCompressionDict(content)
                dictionary.precompute_compress(level=LEVEL)
                self.compressors.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
                ))
        found = self.compressors[which].multi_compress_to_buffer(zstandard.BufferWithSegments(joined, segments), threads=1)
        return np.fromiter(map(len, found), np.int64, len(found))

    def margins(self, words: list[bytes]) -> np.ndarray:
        """Margin of each of some distinct words."""
        new = [word for word in words if word not in self.known]
        if new:
            if len(self.known) + len(new) > KNOWN:
                self.known = {}
                new = words
            windows = _framed(new)
            sizes = np.fromiter(map(len, windows), np.uint64, len(windows))
            segments = np.stack([np.cumsum(sizes) - sizes, sizes], axis=1).astype(np.uint64).tobytes()
            joined = b"".join(windows)
            self.known.update(zip(new, (self._lengths(1, joined, segments) - self._lengths(0, joined, segments)).tolist()))
        return np.fromiter((self.known[word] for word in words), np.int64, len(words))

    def features(self, words: Words) -> np.ndarray:
        """A row per text: one, the largest margin, and the logarithm of the windows that reach each threshold."""
        codes, distinct = words.coded()
        margins = self.margins(distinct.to_pylist())[codes] if len(words) else np.zeros(0, np.int64)
        out = np.zeros((len(words.docs) - 1, 2 + len(THRESHOLDS)))
        out[:, 0] = 1
        some = np.flatnonzero(np.diff(words.docs))
        if len(some):
            out[some, 1] = np.maximum(np.maximum.reduceat(margins, words.docs[some]), 0)
            for column, threshold in enumerate(THRESHOLDS, 2):
                reached = np.concatenate([[0], np.cumsum(margins >= threshold)])
                out[:, column] = np.log1p(reached[words.docs[1:]] - reached[words.docs[:-1]])
        return out

    def score(self, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(words) @ self.curve, -30, 30)))


def _logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Newton's method; ordinary texts weigh twice as much as toxic ones, whatever their numbers."""
    weight = np.where(labels, 0.33 / max(labels.mean(), 1e-9), 0.67 / max(1 - labels.mean(), 1e-9))
    curve = np.zeros(features.shape[1])
    ridge = penalty * np.eye(len(curve))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ curve, -30, 30)))
        slope = features.T @ (weight * (labels - p)) - ridge @ curve
        step = np.linalg.solve((features * (weight * p * (1 - p))[:, None]).T @ features + ridge, slope)
        curve += step
        if np.abs(step).max() < 1e-8:
            break
    return curve


def _contexts(words: Words) -> tuple[Counter, list[bytes]]:
    """How many different words each word follows, and the distinct words."""
    codes, distinct = words.coded()
    before = np.concatenate([[-1], codes[:-1]]) if len(codes) else codes
    first = words.docs[:-1][words.docs[:-1] < len(codes)]
    before[first] = -1
    pairs = np.unique(np.stack([codes, before], axis=1), axis=0)
    counts = np.bincount(pairs[:, 0], minlength=len(distinct)) if len(pairs) else []
    texts = distinct.to_pylist()
    return Counter(dict(zip(texts, map(int, counts)))), texts


def fit(toxic: list[str], ordinary: list[str]) -> Model | None:
    """Model from texts of both classes; the last third of each calibrates, or all if there are fewer than eight."""
    if not toxic or not ordinary:
        return None
    cut = [len(texts) * 2 // 3 if len(texts) >= 8 else len(texts) for texts in (toxic, ordinary)]
    own = [_words(texts[:n]) for texts, n in zip((toxic, ordinary), cut)]
    (mine, _), (others, ordinary_words) = map(_contexts, own)
    sizes = [max(len(words), 1) for words in own]
    typical = [w for w, n in mine.items() if n >= CONTEXTS and n / sizes[0] >= RATIO * (others[w] + 1) / sizes[1] and len(w) > 2]
    typical.sort(key=lambda w: (mine[w], w))
    samples = [w for w in typical for _ in range(min(mine[w], 200))] or sorted(mine, key=lambda w: (mine[w], w))
    if len(ordinary_words) > 100_000:
        ordinary_words = ordinary_words[:: -(-len(ordinary_words) // 100_000)]
    model = Model(_dictionary(_framed(samples)), _dictionary(_framed(ordinary_words)))
    rest = [texts[n:] or texts for texts, n in zip((toxic, ordinary), cut)]
    labels = np.repeat([True, False], [len(rest[0]), len(rest[1])])
    model.curve = _logistic(model.features(_words(rest[0] + rest[1])), labels)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that fitting never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model fitted on a bounded sample of the labelled rows of ``docs``; ``labels`` has doc_id and toxic."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    most = TRAIN_DOCS + CALIBRATION_DOCS
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, TRAIN_BYTES))
    samples = []
    for value in (1, 0):
        # At most ``most`` ids, so the side is small whatever the tables.
        chosen = known.where(F.col("toxic") == value).select("doc_id", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").limit(most)
        found = texts.join(F.broadcast(chosen), "doc_id").select("at", "doc_id", "text").orderBy("at", "doc_id", "text").limit(most).collect()
        samples.append([row.text for row in found])
    return fit(*samples)


def _task(docs: DataFrame, model: Model | None, rows_out, schema):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and shared.value.fresh()
        for rows in slices(batches, "text"):
            data, bounds = flat(rows.column("text"))
            scores = np.zeros(len(rows)) if model is None else model.score(Words(LOWER[data], bounds, IS_WORD))
            yield rows_out(rows, scores)

    return docs.mapInArrow(task, schema)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) per row."""
    return _task(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model,
        lambda rows, scores: pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores)], ["doc_id", "score"]), "doc_id long, score double",
    )


def remove(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more."""
    return _task(docs, model, lambda rows, scores: rows.filter(pa.array(scores < 0.5)), T.StructType(docs.schema.fields))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
