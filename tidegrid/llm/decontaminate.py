"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned over every text.

A window is ``length`` consecutive words of an item; an item with fewer words, but not none, is one window of
all its words. Words are lower-cased (A-Z) runs of ASCII letters, digits and signs beyond ASCII. The set holds
sorted hashes of distinct windows, each with the place of its words in the items, so a hit is verified word by word.

The benchmark is collected and broadcast in parts of about ``PART_BYTES`` of text, an item always whole. An index has
at most ``INDEX_RATIO`` bytes for each byte of its items. Parts are scanned one after the other over the same rows, each
adding to what the earlier ones found; between two parts the rows are written to a staged table and the broadcast is
given back, so the driver and each worker hold one part at a time, however many there are. A benchmark of one part, as
usual, writes nothing. The documents are never shuffled, so copies and hot sources cost no more than others.

Defined cases: a null or wordless text has no hits; a null or wordless item has no windows; an item without id
marks hits but is not listed; repeated items are listed once; rows are judged one by one, so repeated rows and
null ids stay; empty tables give empty results; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import stage

from .arrays import LOWER, Words, binary_array, flat, mixed, slices

WINDOW = 10
PART_BYTES = 8 << 20
# A word of the items takes 28 bytes and its place in the vocabulary, and at least two bytes of text.
INDEX_RATIO = 20
# Digits, letters and every byte of a sign beyond ASCII; upper case is lowered before.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def _hash(codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` codes from each start on; one column at a time, as windows overlap."""
    total = np.zeros(len(starts), np.uint64)
    for k in range(length):
        total = mixed(total + codes[starts + k].astype(np.uint64) + np.uint64(1))
    return total


def _same(codes: np.ndarray, starts: np.ndarray, others: np.ndarray, other_starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` codes from each start on equal those of the other side."""
    same = np.ones(len(starts), bool)
    for k in range(length):
        same &= codes[starts + k] == others[other_starts + k]
    return same


class Windows:
    """Distinct windows of one length, by hash: where each begins in the items' codes, and the items that have it.

    Windows of one hash may be listed twice where others lie between them; a search looks at all of a hash.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, items: np.ndarray, length: int):
        self.length = length
        hashes = _hash(codes, starts, length)
        order = np.argsort(hashes, kind="stable")
        hashes, starts, items = hashes[order], starts[order], items[order]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | ~_same(codes, starts[1:], codes, starts[:-1], length)
        self.hashes, self.first = hashes[fresh], starts[fresh].astype(np.int32)
        window = np.cumsum(fresh) - 1
        # Starts ascend within a window, and so do its items.
        once = fresh.copy()
        once[1:] |= items[1:] != items[:-1]
        self.items = items[once].astype(np.int32)
        self.bounds = np.searchsorted(window[once], np.arange(len(self.first) + 1))

    @property
    def nbytes(self) -> int:
        return self.hashes.nbytes + self.first.nbytes + self.items.nbytes + self.bounds.nbytes

    def find(self, codes: np.ndarray, starts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Verified pairs of one of ``starts`` in ``codes`` and a window; ``own`` are the codes of the items."""
        hashes = _hash(codes, starts, self.length)
        at = np.searchsorted(self.hashes, hashes)
        found = [], []
        while True:
            left = np.flatnonzero(at < len(self.hashes))
            left = left[self.hashes[at[left]] == hashes[left]]
            if not len(left):
                return tuple(np.concatenate(side) if side else np.zeros(0, np.int64) for side in found)
            starts, hashes, at = starts[left], hashes[left], at[left]
            same = _same(codes, starts, own, self.first[at], self.length)
            found[0].append(starts[same])
            found[1].append(at[same])
            at = at + 1


class Index:
    """Windows of benchmark items, by length."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        data, bounds = flat(pa.array([text for _, text in items], pa.string()))
        words = Words(LOWER[data], bounds, IS_WORD)
        codes, self.vocabulary = words.coded()
        self.codes = codes.astype(np.int32)
        self.ids = [item for item, _ in items]
        sizes = np.diff(words.docs)
        lengths = np.minimum(sizes, window)
        self.windows = []
        for length in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == length)
            counts = sizes[own] - length + 1
            before = np.repeat(np.cumsum(counts) - counts, counts)
            starts = np.repeat(words.docs[own], counts) + np.arange(counts.sum()) - before
            self.windows.append(Windows(self.codes, starts, np.repeat(own, counts), length))

    @property
    def nbytes(self) -> int:
        """Bytes of all arrays; the ids are not counted."""
        return self.codes.nbytes + self.vocabulary.nbytes + sum(w.nbytes for w in self.windows)

    def scan(self, words: Words) -> tuple[np.ndarray, list[list[int]]]:
        """Which words are hit, and the items found in each text."""
        distinct_codes, distinct = words.coded()
        n, found = len(words), [set() for _ in range(len(words.docs) - 1)]
        steps = np.zeros(n + 1, np.int64)
        if n == 0 or not self.windows:
            return np.zeros(n, bool), [[] for _ in found]
        known = pc.fill_null(pc.index_in(distinct, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)
        codes = known[distinct_codes].astype(np.int32)
        unknown = np.concatenate([[0], np.cumsum(codes < 0)])
        doc = np.repeat(np.arange(len(found)), np.diff(words.docs))
        for windows in self.windows:
            length = windows.length
            if n < length:
                continue
            inside = (unknown[length:] == unknown[: n - length + 1]) & (doc[length - 1 :] == doc[: n - length + 1])
            starts, which = windows.find(codes, np.flatnonzero(inside), self.codes)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + length, -1)
            for text, one in np.unique(np.stack([doc[starts], which], axis=1), axis=0).tolist():
                found[text].update(windows.items[windows.bounds[one] : windows.bounds[one + 1]].tolist())
        ids = [sorted({self.ids[item] for item in items} - {None}) for items in found]
        return np.cumsum(steps)[:n] > 0, ids


def _passes(rows: DataFrame, benchmark: DataFrame, task_of: Callable, window: int, part_bytes: int) -> DataFrame:
    """``rows`` after one pass of ``task_of(index)`` for each part of the benchmark."""
    spark, schema = rows.sparkSession, T.StructType(rows.schema.fields)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    if parts > 1:
        items = stage(items, "benchmark_items")
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)) == part)
        index = spark.sparkContext.broadcast(Index([tuple(row) for row in own.collect()], window))
        rows = rows.mapInArrow(task_of(index), schema)
        if part + 1 < parts:
            rows = stage(rows, "scanned_part")
            index.destroy()
    return rows


def _unmarked() -> list[Column]:
    """The columns that ``_scan_task`` fills."""
    span = "array<struct<start: bigint, end: bigint>>"
    return [
        F.lit(0).cast("long").alias("n_words"), F.array().cast(span).alias("spans"),
        F.array().cast(span).alias("chars"), F.array().cast("array<bigint>").alias("items"),
    ]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (bounds in words of what is hit), items (ids, ascending).

    ``chars`` has the same spans as byte offsets in the UTF-8 text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_unmarked())
    return _passes(rows, benchmark, _scan_task, window, part_bytes).drop("text")


def _spans(hit: np.ndarray, words: Words) -> list[tuple[list, list]]:
    """Runs of hit words of each text, in words and in bytes; starts and ends count from the text's begin."""
    out = []
    for first, last in zip(words.docs, words.docs[1:]):
        inner = hit[first:last]
        if not inner.any():
            out.append(([], []))
            continue
        edges = np.flatnonzero(np.diff(inner.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        out.append((edges.tolist(), [(int(words.starts[first + a]), int(words.ends[first + b - 1])) for a, b in edges]))
    return out


def _scan_task(index):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            data, bounds = flat(rows.column("text"))
            words = Words(LOWER[data], bounds, IS_WORD)
            hit, items = index.value.scan(words)
            for number, earlier in enumerate(rows.column("spans").to_pylist()):
                for span in earlier:
                    hit[words.docs[number] + span["start"] : words.docs[number] + span["end"]] = True
            items = [sorted({*now, *before}) for now, before in zip(items, rows.column("items").to_pylist())]
            spans, chars = [], []
            for start, (in_words, in_bytes) in zip(bounds.tolist(), _spans(hit, words)):
                spans.append([{"start": a, "end": b} for a, b in in_words])
                chars.append([{"start": a - start, "end": b - start} for a, b in in_bytes])
            made = {"n_words": np.diff(words.docs), "spans": spans, "chars": chars, "items": items}
            columns = [pa.array(made[f.name], f.type) if f.name in made else rows.column(f.name) for f in rows.schema]
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return task


def _filter_task(index):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            data, bounds = flat(rows.column("text"))
            words = Words(LOWER[data], bounds, IS_WORD)
            counts = np.concatenate([[0], np.cumsum(index.value.scan(words)[0])])
            yield rows.filter(pa.array(counts[words.docs[1:]] == counts[words.docs[:-1]]))

    return task


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without the bytes of ``chars``."""
    for rows in slices(batches, "text"):
        data, bounds = flat(rows.column("text"))
        keep = np.ones(len(data), bool)
        for start, spans in zip(bounds.tolist(), rows.column("chars").to_pylist()):
            for span in spans:
                keep[start + span["start"] : start + span["end"]] = False
        left = np.concatenate([[0], np.cumsum(keep)])[bounds]
        kind = rows.column("text").type
        texts = pc.if_else(pc.is_valid(rows.column("text")), binary_array(data[keep], left).cast(kind), pa.scalar(None, kind))
        yield pa.RecordBatch.from_arrays([rows.column("row"), texts], ["row", "text"])


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "documents", window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` without contaminated rows, or (``what="spans"``) with the hit words cut from the texts.

    Spans of all parts are found in the whole texts before any is cut.
    """
    if what == "documents":
        return _passes(docs, benchmark, _filter_task, window, part_bytes)
    if what != "spans":
        raise ValueError(f"what is 'documents' or 'spans', not {what!r}")
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    marked = _passes(docs.select(row, "text", *_unmarked()), benchmark, _scan_task, window, part_bytes).select("row", "text", "chars")
    cut = marked.mapInArrow(_cut, T.StructType([marked.schema["row"], marked.schema["text"]]))
    return cut.select(*(F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in docs.columns))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What was found per row, as counts and a digest of the item ids."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return scan(docs, benchmark).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
