"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

1. ``_word_rows``: each task cuts its texts into pre-tokens, in blocks of a few megabytes, numbers the distinct
   ones by falling count, and sends them out by a hash of the word, packed: one row per block and word bucket.
2. ``_encode_rows``: a bucket sees every block's words of its own hash range and encodes each distinct word once.
3. ``_position_rows`` has, per block, the word number at every position. It meets the block's encoded words by
   the block's key, and ``_reassemble`` puts the ids in text order. ``decode`` joins ids with the token bytes;
   ``digests`` does that in the worker that put the ids in order.

A worker holds a block's texts and a few bytes per word of it. What needs many bytes per sign or id (cutting, gathering,
decoding) goes through a block in windows of ``WINDOW_BYTES`` and parts of ``PART_WORDS`` words, the same for every input.

Hot words cost one entry per block, so no task grows with a word's count. Blocks are cut from the scan, so both
passes over the documents must read the same splits: they read the same frame, and each block carries its number
of rows and words, which are compared.

Defined cases: a null text is empty and has no ids; repeated rows and null ids are encoded row by row; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import binary_array, blocks, flat, gathered, give_back, slices

BLOCK_BYTES = 8 << 20
# Texts are cut into words in windows of about so many bytes, and ids gathered for about so many words at a time.
WINDOW_BYTES = 1 << 20
PART_WORDS = 1 << 17
# A bucket forgets its words beyond so many; a word met again is then encoded again.
BUCKET_WORDS = 2_000_000
_LETTER, _DIGIT, _OTHER, _SPACE = range(4)
_ROWS = "block long, kind int, part int, size long, a binary, b binary, doc_ids array<long>"
_SCHEMA = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("size", pa.int64()),
    ("a", pa.binary()), ("b", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
])


def read_ranks(path: str) -> bytes:
    """The rank file as it is; it is as large as the vocabulary."""
    with open(path, "rb") as file:
        return file.read()


@functools.lru_cache(2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@functools.lru_cache(2)
def _token_bytes(ranks: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens joined, and start and length by id."""
    table = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, ranks.splitlines())}
    lengths = np.zeros(max(table) + 1, np.int64)
    for rank, token in table.items():
        lengths[rank] = len(token)
    joined = b"".join(table[rank] for rank in sorted(table))
    return np.frombuffer(joined, np.uint8), np.cumsum(lengths) - lengths, lengths


@functools.lru_cache(1)
def _kinds() -> np.ndarray:
    """Letter, digit, space or other, by code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
            for found in regex.finditer(pattern, every):
                kinds[low + found.start() : low + found.end()] = kind
    return kinds


def _window_end(data: np.ndarray, doc_offsets: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word goes on: the end of a text, or a space or line feed after an ASCII sign.

    White space after another sign always starts a word, whatever stands before or after; behind other white space it may not.
    """
    stop = int(doc_offsets[np.searchsorted(doc_offsets, at)]) if at < len(data) else len(data)
    for low in range(at, stop, 1 << 16):
        signs = data[low - 1 : min(low + (1 << 16), stop)]
        found = np.flatnonzero(((signs[1:] == 32) | (signs[1:] == 10)) & (signs[:-1] > 32) & (signs[:-1] < 127))
        if len(found):
            return low + int(found[0])
    return stop


def _word_starts(data: np.ndarray, doc_offsets: np.ndarray) -> np.ndarray:
    """Byte offset of each pre-token of one window; ``doc_offsets``: where texts start in it, beside its own start."""
    at = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(chars)
    kind = _kinds()[chars]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, doc_offsets)] = True
    first[0] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    before_word = (kind == _SPACE) & run[1:] & ~first[1:]
    start = run[:n] | before_word
    start[1:] &= ~(before_word & (chars == 32))[:-1]
    quote = np.flatnonzero((chars == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    one = quote[np.isin(chars[quote + 1], [ord(c) for c in "stmd"])]
    long = quote[quote + 2 < n]
    long = long[~first[long + 2]]
    pair = chars[long + 1].astype(np.int64) << 32 | chars[long + 2]
    two = long[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    for where, length in ((one, 2), (two, 3)):
        start[where + 1] = False
        after = where + length
        start[after[after < n]] = True
    return at[start]


def pretokens(data: np.ndarray, doc_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset of each pre-token (one more at the end), and number of the first pre-token of each text.

    The boundaries are those of the published pattern: English contractions, letters, digits or other
    signs with one space before them, and white space, whose last sign before a word stands apart.
    """
    found, low = [], 0
    while low < len(data):
        high = _window_end(data, doc_offsets, low + WINDOW_BYTES)
        own = doc_offsets[np.searchsorted(doc_offsets, low) : np.searchsorted(doc_offsets, high)]
        found.append(_word_starts(data[low:high], own - low) + np.int64(low))
        low = high
    offsets = np.concatenate([*found, np.array([len(data)], np.int64)])
    return offsets, np.searchsorted(offsets[:-1], doc_offsets)


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as zstandard-compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Per block: its key, its rows, the word at each position, the first position of each text, the words."""
    for number, rows in enumerate(blocks(batches, "text", BLOCK_BYTES)):
        data, doc_offsets = flat(rows.column("text"))
        offsets, docs = pretokens(data, doc_offsets)
        coded = binary_array(data, offsets).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words = coded.dictionary.take(pa.array(order))
        codes = rank[codes]
        del data, offsets, coded
        yield rows.column("split")[0].as_py() << 32 | number, rows, codes, docs, words
    # The worker outlives the task and would keep what Arrow has set aside.
    give_back()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows, one at a time: they are large."""
    for batch in batches:
        for number in range(len(batch)):
            yield batch.slice(number, 1).to_pylist()[0]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _word_rows(buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words in _blocks(batches):
            texts = words.to_pylist()
            bucket = np.fromiter((zlib.crc32(w) for w in texts), np.uint32, len(texts)) % buckets
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            compressor = zstandard.ZstdCompressor(level=3)
            out = []
            for part in range(buckets):
                mine = order[bounds[part] : bounds[part + 1]]
                if len(mine):
                    joined = b"".join(texts[i] for i in mine)
                    sizes = np.fromiter((len(texts[i]) for i in mine), np.int64, len(mine))
                    steps = np.diff(mine, prepend=0)
                    out.append((block, 0, part, len(texts), _packed(np.concatenate([steps, sizes])), compressor.compress(joined), None))
            if out:
                yield _rows(out)

    return task


def _encode_rows(ranks, pattern: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value, pattern).encode_ordinary
        known: dict[bytes, list[int]] = {}
        for row in _each(batches):
            numbers = _unpacked(row["a"]).reshape(2, -1).astype(np.int64)
            ends = np.cumsum(numbers[1])
            joined = zstandard.ZstdDecompressor().decompress(row["b"]) if ends[-1] else b""
            ids, counts, start = [], [], 0
            for end in ends.tolist():
                word = joined[start:end]
                start = end
                found = known.get(word)
                if found is None:
                    if len(known) >= BUCKET_WORDS:
                        known.clear()
                    found = known[word] = encode(word.decode("utf-8"))
                ids += found
                counts.append(len(found))
            a = _packed(np.concatenate([numbers[0], np.array(counts, np.int64)]))
            yield _rows([(row["block"], 0, row["part"], row["size"], a, _packed(np.array(ids, np.int64)), None)])
        known.clear()
        give_back()

    return task


def _position_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, rows, codes, docs, words in _blocks(batches):
        yield _rows([(block, 1, 0, len(words), _packed(codes), _packed(np.diff(docs)), rows.column("doc_id").to_pylist())])


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: of each block its encoded words, then its positions. A block goes out in parts of whole texts."""
    block, words = None, []
    for row in _each(batches):
        if row["block"] != block:
            block, words = row["block"], []
        if row["kind"] == 0:
            words.append((row["a"], row["b"]))
            continue
        counts = np.zeros(row["size"], np.int64)
        starts = np.zeros(row["size"], np.int64)
        pool, used, seen = [np.zeros(0, np.uint32)], 0, 0
        for a, b in words:
            steps, lengths = _unpacked(a).reshape(2, -1).astype(np.int64)
            mine = np.cumsum(steps)
            counts[mine] = lengths
            starts[mine] = used + np.cumsum(lengths) - lengths
            pool.append(_unpacked(b))
            used += len(pool[-1])
            seen += len(mine)
        if seen != row["size"]:
            raise RuntimeError(f"block {block} has {row['size']} words, {seen} were encoded")
        words, pool = [], np.concatenate(pool)
        codes = _unpacked(row["a"]) if row["size"] else np.zeros(0, np.uint32)
        bounds = np.concatenate([[0], np.cumsum(_unpacked(row["b"]), dtype=np.int64)])
        doc_ids, low = row["doc_ids"], 0
        while low < len(doc_ids):
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + PART_WORDS, side="right")) - 1)
            part = codes[bounds[low] : bounds[high]]
            lengths = counts[part]
            ids = gathered(pool, starts[part], lengths)
            ends = np.concatenate([[0], np.cumsum(lengths)])[bounds[low : high + 1] - bounds[low]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[low:high], pa.int64()), binary_array(ids.astype("<u4").view(np.uint8), ends * 4).cast(pa.binary())],
                ["doc_id", "ids"],
            )
            low = high
    give_back()


def _decoded(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[pa.RecordBatch]:
    data, starts, lengths = _token_bytes(ranks)
    for rows in slices(batches, "ids"):
        raw, bounds = flat(rows.column("ids"))
        ids = raw.view("<u4").astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])[bounds // 4]
        decoded = binary_array(gathered(data, starts[ids], lengths[ids]), ends).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([*rows.columns, decoded], [*rows.schema.names, "decoded"])
    give_back()


def _blocks_together(docs: DataFrame, table, pattern: str, buckets: int | None = None) -> DataFrame:
    """Encoded words and positions of each block, in the order that ``_reassemble`` needs."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("split"))
    words = (
        texts.mapInArrow(_word_rows(buckets), _ROWS).repartition(buckets, "part")
        .mapInArrow(_encode_rows(table, pattern), _ROWS)
    )
    positions = texts.mapInArrow(_position_rows, _ROWS)
    return words.unionByName(positions).repartition("block").sortWithinPartitions("block", "kind", "part")


def encode(docs: DataFrame, ranks: bytes, pattern: str, buckets: int | None = None) -> DataFrame:
    """One row (doc_id, ids) per row of ``docs``; ids are little-endian unsigned 32-bit integers in one binary."""
    table = docs.sparkSession.sparkContext.broadcast(ranks)
    return _blocks_together(docs, table, pattern, buckets).mapInArrow(_reassemble, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """Adds ``decoded``, the bytes of the tokens of each row's ``ids``."""
    table = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(lambda batches: _decoded(batches, table.value), f"{schema}, decoded binary")


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Encode, decode, and describe both results per row.

    The last step of ``encode`` and that of ``decode`` follow each other in one worker: as two Python workers in a chain,
    ids went through the JVM in between and an executor held twice the processes.
    """
    table = docs.sparkSession.sparkContext.broadcast(ranks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_reassemble(batches), table.value)

    both = _blocks_together(docs, table, pattern).mapInArrow(task, "doc_id long, ids binary, decoded binary")
    return both.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenizer_file(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a public vocabulary file; the setting ``tidegrid.tokenizers`` names another folder."""
    folder = spark.conf.get("tidegrid.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)
