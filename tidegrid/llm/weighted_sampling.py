"""Document fingerprints by consistent weighted sampling over weighted word pairs.

A term is two neighbouring words, weighted by how often the text has it (a text of one word is that word; a text
of signs without words is one term). For each of ``SAMPLES`` hash functions a term draws, from its own hash, r and c
from a Gamma(2, 1) distribution and b uniformly; with its weight w it takes the step t = floor(ln w / r + b), the point
y = exp(r (t - b)) and the value c / (y exp(r)). The term of the least value, with its step, is the sample. Two texts
agree in a sample with the probability of their generalised Jaccard similarity. A sample is kept as 16 bits.

Documents are dealt out by ranges of the id, each range in one task in falling order, with one more row: the first
of the next range. So every document meets its successor without a global sort, and only texts move, once.

Defined cases: null and empty texts have the fingerprint of zeros and are like each other only (likeness 1); ids that
are equal are ordered by text; rows without id come last; a single document is its own successor; an
empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, Words, flat, mixed, slices
from .decontaminate import IS_WORD

SAMPLES = 64
# Terms drawn at a time, and terms of a text above which they are drawn without a table.
_ROWS = 2_048
LONG = 100_000
_GROUP_BYTES = 1 << 20
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def _hashed(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of numbers that stand for its bytes."""
    data, bounds = flat(words)
    if not len(data):
        return np.zeros(0, np.uint64)
    sizes = np.diff(bounds)
    powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
    within = np.arange(len(data)) - np.repeat(bounds[:-1], sizes)
    return mixed(np.add.reduceat(_BYTES[data] * powers[within], bounds[:-1]))


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, hash and count of each distinct term of each text, in the order of texts."""
    data, bounds = flat(pa.array(texts, pa.string()))
    words = Words(LOWER[data], bounds, IS_WORD)
    codes, distinct = words.coded()
    hashes = _hashed(distinct)[codes]
    per_doc = np.diff(words.docs)
    doc = np.repeat(np.arange(len(texts)), per_doc)
    pairs = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    single = np.flatnonzero(per_doc == 1)
    signs = [i for i in np.flatnonzero(per_doc == 0).tolist() if texts[i]]
    doc = np.concatenate([doc[pairs], single, np.array(signs, np.int64)])
    other = np.fromiter((xxhash.xxh64_intdigest(texts[i].encode()) for i in signs), np.uint64, len(signs))
    term = mixed(np.concatenate([mixed(hashes[pairs]) * np.uint64(3) + hashes[pairs + 1] if len(pairs) else np.zeros(0, np.uint64), hashes[words.docs[single]], other]))
    if len(single) or signs:
        order = np.argsort(doc, kind="stable")
        doc, term = doc[order], term[order]
    # Exact keys: a number for each distinct term, and one for each pair of a text and a term; texts stay in order.
    numbers, terms = pd.factorize(term)
    codes, pairs = pd.factorize(doc * max(len(terms), 1) + numbers)
    return pairs // max(len(terms), 1), terms[pairs % max(len(terms), 1)], np.bincount(codes, minlength=len(pairs))


def _drawn(term: np.ndarray, weight: np.ndarray, samples: int) -> np.ndarray:
    """A row per term: for each hash function, its value in the high bits and its sample in the low 16."""
    seeds = mixed(np.arange(1, samples + 1, dtype=np.uint64))
    x = (term[:, None] ^ seeds) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    y = x * np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(30)
    low, middle, half, scale = np.uint64(0xFFFFFF), np.uint64(24), np.float32(0.5), np.float32(2.0**-48)

    def log_of_two(bits: np.ndarray) -> np.ndarray:
        one = (bits & low).astype(np.int32).astype(np.float32)
        one += half
        other = (bits >> middle & low).astype(np.int32).astype(np.float32)
        other += half
        one *= other
        one *= scale
        return np.log(one, out=one)

    minus_r, value = log_of_two(x), log_of_two(y)
    np.negative(value, out=value)
    np.log(value, out=value)
    value += minus_r
    b = (x >> np.uint64(48)).astype(np.int32).astype(np.float32)
    b *= np.float32(2.0**-16)
    sample = np.repeat((term & np.uint64(0xFFFF)).astype(np.int64)[:, None], samples, axis=1)
    # A weight of one has the logarithm zero, so its step is zero.
    some = np.flatnonzero(weight > 1)
    t = np.floor(b[some] - np.log(weight[some].astype(np.float32))[:, None] / minus_r[some])
    b[some] -= t
    sample[some] = sample[some] + t.astype(np.int64) * 40_503 & 0xFFFF
    b *= minus_r
    value -= b
    order = value.view(np.int32)
    order = (order ^ (order >> 31 & 0x7FFFFFFF)).astype(np.int64)
    order <<= 16
    order |= np.maximum(sample, 1, out=sample)
    return order


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """A row of 16-bit samples per text."""
    doc, term, weight = _terms(texts)
    out = np.zeros((len(texts), samples), np.uint16)
    if not len(doc):
        return out
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    ends = np.append(starts[1:], len(doc))
    usual = np.repeat(ends - starts <= LONG, ends - starts)
    # Texts share most of their terms with their edited form; each is drawn once.
    numbers, terms = pd.factorize(term[usual])
    which, keys = pd.factorize(weight[usual] * len(terms) + numbers)
    at = np.empty(len(keys), np.int64)
    at[which] = np.flatnonzero(usual)
    table = np.empty((len(at), samples), np.int64)
    for row in range(0, len(at), _ROWS):
        part = at[row : row + _ROWS]
        table[row : row + _ROWS] = _drawn(term[part], weight[part], samples)
    place = np.cumsum(usual) - 1
    for start, end in zip(starts.tolist(), ends.tolist()):
        if end - start <= LONG:
            least = table[which[place[start] : place[start] + end - start]].min(axis=0)
        else:
            rows = (slice(row, min(row + _ROWS, end)) for row in range(start, end, _ROWS))
            least = np.min([_drawn(term[part], weight[part], samples).min(axis=0) for part in rows], axis=0)
        out[doc[start]] = least & 0xFFFF
    return out


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many signs from the begin of ``following``, or all that it has."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _spread(docs: DataFrame, parts: int) -> DataFrame:
    """Rows with ``part`` (0 holds the largest ids) and ``extra``: 1 for a copy of the first row of the next part."""
    fractions = [i / parts for i in range(1, parts)] or [0.5]
    found, least = docs.agg(F.percentile_approx("doc_id", fractions, 10_000), F.min("doc_id")).first()
    # Every part but an all-null table's has an id.
    bounds = np.array(sorted({b for b in found or [] if b > least}), np.int64)
    # Rows without id go with the smallest ids.
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))

    def own(ids) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="right")

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(own(ids))

    # One number per part: as many as the shuffle has partitions.
    heads = sorted(map(tuple, docs.select(part_of(key).alias("part"), "doc_id").groupBy("part").agg(F.max("doc_id")).collect()))
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads) if head is not None}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        return pd.Series([[p, before[i]] if i in before else [p] for p, i in zip(own(ids).tolist(), ids.tolist())])

    return docs.withColumn("places", places(key)).select("doc_id", "text", F.posexplode("places").alias("extra", "part"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per row: its fingerprint, its edited text's, its successor's likeness to it."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = (
        _spread(rows, parts).repartition(parts, "part")
        .sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), "text")
    )
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def finished(rows: list[tuple], following: list[tuple]) -> pa.RecordBatch:
        """Rows and the successor of the last one; both as (id, text)."""
        texts = [text for _, text in rows + following]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        signs = signatures(texts + changed, samples)
        own, other = signs[: len(rows)], signs[len(texts) :]
        hexed = lambda part: [row.astype(">u2").tobytes().hex() for row in part]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts[: len(rows)]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(hexed(own)), pa.array(hexed(other)),
            pa.array((own == other).mean(axis=1)), pa.array((own == signs[1 : len(texts)]).mean(axis=1)),
        ], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held, size = None, None, [], 0

        def ended() -> Iterator[pa.RecordBatch]:
            if held:
                yield finished(held, [first])

        for batch in slices(batches, "text", _GROUP_BYTES):
            columns = (batch.column(c).to_pylist() for c in ("part", "extra", "doc_id", "text"))
            for own, extra, doc_id, text in zip(*columns):
                if own != part:
                    yield from ended()
                    part, first, held, size = own, (doc_id, text), [], 0
                if extra:
                    if held:
                        yield finished(held, [(doc_id, text)])
                    held, size = [], 0
                    continue
                if size >= _GROUP_BYTES:
                    yield finished(held, [(doc_id, text)])
                    held, size = [], 0
                held.append((doc_id, text))
                size += len(text)
        yield from ended()

    return dealt.mapInArrow(
        task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
