"""Token ids as wavelet matrices: per shard one compressed file that answers access, counts and occurrences.

A shard holds the ids of consecutive documents (ascending doc_id, each closed by an end id) as sixteen bit-planes. A
plane holds one bit of every id, the highest first; behind each plane ids are parted stably by its bit. Planes are cut in
blocks of ``BLOCK_BITS``, each compressed alone, with the number of ones before it: a rank or select opens one block
per plane. Bytes of a file: magic, length of the header, header (JSON, zstandard), blocks.

Texts are cut into pieces that the tokenizer can never join (at white space, which has no ids, and at changes between ASCII
letters, digits and other signs), and a worker encodes each distinct piece once, so the library sees a small part of the
text. A definition that does not drop white space and make lower case by itself is refused.

Documents are dealt out by ranges of the id and sorted, and a task writes its shards as it goes. An attempt writes
files of its own name; only those that a finished task reports are read. Shards are cut by tokens, so memory is
bounded. The sum of tokens before a shard comes from the shard list: sums per task first, then within a task.

Defined cases: a null text is empty and has the end id only; rows without id come first, ids that are equal are ordered
by text; an empty table gives no file and an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.session import stage, staging_path

from . import files
from .arrays import LOWER, binary_array, flat, give_back, slices
from .known import Known

END = 1
BITS = 16
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 4_000_000
# Distinct pieces whose ids a worker remembers, twice; pieces that go to the library at once.
KNOWN = 250_000
CALL = 5_000
MAGIC = b"WVM1"
_SLICE = 4 << 20
# 1 ASCII letter, 2 digit, 3 white space, 4 other sign, 0 part of a sign beyond ASCII.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[9:14] = _CLASS[32] = 3
_CLASS[128:] = 0
_BLANK = 3
# What the cut at white space and signs relies on: fixed values of the tokenizer's definition.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
_SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True,
}


# Files ------------------------------------------------------------------------------------------------------------


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """File of the ids of some documents."""
    current = ids.astype(np.uint16)
    compressor = zstandard.ZstdCompressor(level=3)
    planes, blocks, offset = [], [], 0
    for level in range(BITS):
        bit = (current >> (BITS - 1 - level) & 1).astype(bool)
        plane = {"zeros": int(len(bit) - np.count_nonzero(bit)), "at": [], "ones": []}
        ones = 0
        for start in range(0, len(bit), BLOCK_BITS):
            part = bit[start : start + BLOCK_BITS]
            packed = compressor.compress(np.packbits(part, bitorder="little").tobytes())
            plane["at"].append(offset)
            plane["ones"].append(ones)
            ones += int(np.count_nonzero(part))
            offset += len(packed)
            blocks.append(packed)
        planes.append(plane)
        current = np.concatenate([current[~bit], current[bit]])
    header = compressor.compress(json.dumps({"n": len(ids), "size": offset, "doc_ids": doc_ids, "lengths": lengths, "planes": planes}).encode())
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *blocks])


class WaveletFile:
    """Queries on the bytes of one file, or on anything that can be sliced like them."""

    def __init__(self, content):
        if content[:4] != MAGIC:
            raise ValueError("not a wavelet file")
        size = int.from_bytes(content[4:12], "little")
        header = json.loads(zstandard.ZstdDecompressor().decompress(content[12 : 12 + size]))
        self.content, self.base = content, 12 + size
        self.n, self.size, self.doc_ids, self.lengths, self.planes = (header[k] for k in ("n", "size", "doc_ids", "lengths", "planes"))
        self._ends = [at for plane in self.planes for at in plane["at"]] + [self.size]
        self._block = functools.lru_cache(64)(self._read_block)

    def _read_block(self, level: int, block: int) -> np.ndarray:
        start = self.planes[level]["at"][block]
        end = self._ends[len(self.planes[0]["at"]) * level + block + 1]
        raw = zstandard.ZstdDecompressor().decompress(self.content[self.base + start : self.base + end])
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=min(BLOCK_BITS, self.n - block * BLOCK_BITS), bitorder="little")

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i == 0:
            return 0
        block = (i - 1) // BLOCK_BITS
        return self.planes[level]["ones"][block] + int(np.count_nonzero(self._block(level, block)[: i - block * BLOCK_BITS]))

    def _position(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of that value in a plane."""
        before = np.array(self.planes[level]["ones"])
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - before[block]])

    def access(self, i: int) -> int:
        """Id at a position."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(BITS):
            bit = int(self._block(level, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._ones(level, i)
            value, i = value << 1 | bit, self.planes[level]["zeros"] + ones if bit else i - ones
        return value

    def _narrowed(self, token: int, start: int, end: int) -> tuple[int, int]:
        for level in range(BITS):
            a, b = self._ones(level, start), self._ones(level, end)
            zeros = self.planes[level]["zeros"]
            start, end = (zeros + a, zeros + b) if token >> (BITS - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the id is at positions ``start`` to ``end``."""
        a, b = self._narrowed(token, start, self.n if end is None else end)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of the id."""
        start, end = self._narrowed(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = start + k
        for level in reversed(range(BITS)):
            bit = token >> (BITS - 1 - level) & 1
            at = self._position(level, bit, at - self.planes[level]["zeros"] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids, planes undone from the last."""
        current = np.zeros(self.n, np.uint16)
        for level in reversed(range(BITS)):
            blocks = len(self.planes[level]["at"])
            bit = np.concatenate([self._read_block(level, b) for b in range(blocks)]).astype(bool) if blocks else np.zeros(0, bool)
            zeros, before = self.planes[level]["zeros"], np.empty_like(current)
            before[~bit] = current[:zeros]
            before[bit] = current[zeros:] | np.uint16(1 << (BITS - 1 - level))
            current = before
        return current


# Encoding ---------------------------------------------------------------------------------------------------------


class _Encoder:
    """The tokenizer with the ids of pieces already seen."""

    def __init__(self, definition: str, known: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        if rules["normalizer"] != _NORMALIZER or rules["pre_tokenizer"]["pretokenizers"][0] != _SPLIT:
            raise ValueError("texts are cut for another tokenizer than this")
        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(self._encoded, known)

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        # Small ASCII letters pass the definition's cutting and changing untouched, so they go to its merges at once.
        merges, found = self.tokenizer.model.tokenize, {}
        others = []
        for piece in pieces:
            if piece.isalpha() and piece.islower():
                found[piece] = array("H", [token.id for token in merges(piece.decode())]).tobytes()
            else:
                others.append(piece)
        for at in range(0, len(others), CALL):
            part = others[at : at + CALL]
            encoded = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            found.update(zip(part, (array("H", e.ids).tobytes() for e in encoded)))
        return [found[piece] for piece in pieces]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts joined, and the number of ids of each."""
        raw = data.tobytes()
        whole = {
            i for word in self.special if word in raw
            for i in range(len(bounds) - 1) if word in raw[bounds[i] : bounds[i + 1]]
        }
        kind = _CLASS[data]
        for i in whole:
            # The library knows its special words only in a text as it is.
            kind[bounds[i] : bounds[i + 1]] = 0
        keep = kind != _BLANK
        start = np.zeros(len(data), bool)
        # White space parts whatever stands on its sides; other signs part from signs of another class if both are ASCII.
        start[1:] = (kind[1:] != kind[:-1]) & (kind[1:] != 0) & (kind[:-1] != 0) & ~((data[:-1] == 39) & (kind[1:] == 1)) | ~keep[:-1]
        start[bounds[:-1][bounds[:-1] < len(data)]] = True
        start &= keep
        starts = np.flatnonzero(start)
        # No text of a row reaches 2 GB, and a slice has one row or a few megabytes.
        before = np.zeros(len(data) + 1, np.int32)
        np.cumsum(keep, dtype=np.int32, out=before[1:])
        # The tokenizer makes lower case of everything; done first for ASCII, fewer pieces differ.
        lower = LOWER[data] if not whole else data
        ids, counts = self.known.numbers(lower[keep], before[starts], "<u2")
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[np.searchsorted(starts, bounds)])


@functools.lru_cache(1)
def _encoder(definition: str) -> _Encoder:
    return _Encoder(definition)


def write(docs: DataFrame, definition: str, folder: str, end: int = END) -> DataFrame:
    """Writes shards below ``folder``; a row (task, number, path, n_docs, n_tokens) for each, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    schema = pa.schema([("task", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, attempt, part = _encoder(shared.value), uuid.uuid4().hex, TaskContext.get().partitionId()
        ids, doc_ids, lengths, number = [], [], [], 0

        def flushed() -> pa.RecordBatch:
            path = f"{folder}/{attempt}-{number}.wvm"
            files.write(path, build(np.concatenate(ids), doc_ids, lengths))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, number, path, len(doc_ids), sum(lengths)), schema)], schema=schema)

        for rows in slices(batches, "text", _SLICE):
            found, counts = encoder.encode(*flat(rows.column("text")))
            ends = np.cumsum(counts)
            ids.append(np.insert(found, ends, end).astype(np.uint16))
            doc_ids += rows.column("doc_id").to_pylist()
            lengths += (counts + 1).tolist()
            if sum(map(len, ids)) >= SHARD_TOKENS:
                yield flushed()
                ids, doc_ids, lengths, number = [], [], [], number + 1
        if doc_ids:
            yield flushed()
        give_back()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    )
    return stage(ordered.mapInArrow(task, "task int, number int, path string, n_docs long, n_tokens long"), "shards")


def with_starts(shards: DataFrame) -> DataFrame:
    """``shards`` with ``before``, the tokens of all shards before."""
    within = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the writing job, so this window is small whatever the shards hold.
    tasks = shards.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    earlier = tasks.withColumn("earlier", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inner = shards.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inner.join(earlier, "task").select("path", (F.col("inner") + F.col("earlier")).cast("long").alias("before"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the shards that a task gets."""
    for batch in batches:
        for row in batch.to_pylist():
            shard = WaveletFile(files.read(row["path"]))
            tokens = shard.tokens()
            bounds = np.concatenate([[0], np.cumsum(np.array(shard.lengths, np.int64))])
            for at in range(0, len(shard.doc_ids), 1_000):
                some = bounds[at : at + 1_001]
                data = tokens[some[0] : some[-1]].astype("<u2").view(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.doc_ids[at : at + 1_000], pa.int64()), pa.array(row["before"] + some[:-1], pa.int64()),
                    binary_array(data, (some - some[0]) * 2).cast(pa.binary()),
                ], ["doc_id", "start", "ids"])
    give_back()


def _dealt(shards: DataFrame) -> DataFrame:
    return shards.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read(shards: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document of shards (path, before); ids are unsigned 16-bit integers in one binary."""
    return _dealt(shards).mapInArrow(_documents, "doc_id long, start long, ids binary")


def digests(spark: SparkSession, docs: DataFrame, definition: str) -> DataFrame:
    """Every document through a shard and back: start, n_tokens and crc32 of the ids as 32-bit integers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The ids of a document go from its shard to its digest in one worker.
        for rows in slices(_documents(batches), "ids"):
            data, bounds = flat(rows.column("ids"))
            wide = data.view("<u2").astype("<u4").view(np.uint8)
            sums = [zlib.crc32(wide[a:b]) for a, b in zip((bounds[:-1] * 2).tolist(), (bounds[1:] * 2).tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("start"), pa.array(np.diff(bounds) // 2), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    shards = with_starts(write(docs, definition, staging_path(spark, "wavelet")))
    return _dealt(shards).mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")
