"""Tokens of two tokenizers side by side: groups that cover the same bytes, and how often ids end together.

1. ``align``: texts are cut where neither tokenizer joins anything, at blanks behind other signs. A worker encodes each
   distinct piece by both tokenizers once and intersects the two lists of byte ends: ``common_ends`` takes the ends of the
   shorter list and finds each in the longer by doubling steps and then halving, from where the last one was found. Common
   ends cut a piece into groups; the difference of ranks of neighbouring ends is the range of tokens in a group. The
   groups of a text are those of its pieces in order. Rows are blocks of a few megabytes of text, packed.
2. ``pair_counts``: a block's links (A and B tokens that end together) are added up by pair of ids before they are
   shuffled, so a pair is one row per block however often it occurs.
3. ``digests``: counts go back to the blocks that hold the pair, and each text adds up its links.

Blocks are written once and read by steps 2 and 3; texts are read once.

Defined cases: a text that is null or empty has no tokens, nor has one whose tokens do not give back its bytes (U+2581 is
a blank to one of the tokenizers). Such texts have zeros, no links in the counts, and an empty string as digest. Repeated rows
and null ids are rows of their own; ties for the highest count are all the best; an empty table gives an empty result;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stage

from . import piece_bpe
from .arrays import blocks as cut_blocks
from .arrays import flat, gathered
from .byte_bpe import _packed, _unpacked
from .known import Known, cuts, with_space

BLOCK_BYTES = 2 << 20
# Pieces that go to the libraries at once; what they return is large.
CALL = 2_000
_PARTS = ("codes", "docs", "n_a", "n_b", "n_groups", "a", "b", "a_cuts", "b_cuts")
_BLOCK = "block long, doc_ids array<long>, " + ", ".join(f"{name} binary" for name in _PARTS)


def common_ends(left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    """Places in both rising lists of the values that they share."""
    short, long = (left, right) if len(left) <= len(right) else (right, left)
    in_short, in_long, at, size = [], [], 0, len(long)
    for place, value in enumerate(short):
        step = 1
        while at + step < size and long[at + step] < value:
            step *= 2
        at = bisect_left(long, value, at + step // 2, min(at + step + 1, size))
        if at == size:
            break
        if long[at] == value:
            in_short.append(place)
            in_long.append(at)
    return (in_short, in_long) if short is left else (in_long, in_short)


def _byte_signs() -> dict[str, int]:
    """The signs that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Both:
    """Both tokenizers, and the groups of a piece of text."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        cutter = rules["pre_tokenizer"] or {}
        if rules["normalizer"] or cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("the first tokenizer must be byte-level with the published pattern")
        self.first = Tokenizer.from_str(definition)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        signs = _byte_signs()
        names = [self.first.id_to_token(i) for i in range(self.first.get_vocab_size())]
        special = {t.content for t in self.first.get_added_tokens_decoder().values()}
        self.a_bytes = [name.encode() if name in special else bytes(signs[c] for c in name) for name in names]
        texts, _, kinds = piece_bpe.read_model(model)
        self.b_bytes = [bytes([int(t[3:5], 16)]) if k == piece_bpe.BYTE else t.replace(piece_bpe.BLANK, " ").encode() for t, k in zip(texts, kinds)]
        self.cut = not any(k == piece_bpe.NORMAL and piece_bpe.BLANK in t.lstrip(piece_bpe.BLANK) for t, k in zip(texts, kinds))

    def groups(self, pieces: list[bytes]) -> list[bytes]:
        return [value for at in range(0, len(pieces), CALL) for value in self._groups(pieces[at : at + CALL])]

    def _groups(self, pieces: list[bytes]) -> list[bytes]:
        """Of each piece, which starts with a blank: three sizes, both lists of ids, and both lists of group ends; all zero if bytes differ."""
        texts = [p.decode() for p in pieces]
        left = self.first.encode_batch_fast(texts, add_special_tokens=False)
        right = self.second.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for piece, encoded, b in zip(pieces, left, right):
            a = encoded.ids
            of_a, of_b = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
            if len(piece) == 1:
                # The library leaves out the blank before an empty text.
                b, of_b = ([self.second.piece_to_id(piece_bpe.BLANK)], [b" "]) if not b else (b, of_b)
            if b"".join(of_a) != piece or b"".join(of_b) != piece:
                out.append(array("I", [0, 0, 0]).tobytes())
                continue
            in_a, in_b = common_ends(list(accumulate(map(len, of_a))), list(accumulate(map(len, of_b))))
            out.append(array("I", [len(a), len(b), len(in_a), *a, *b, *(i + 1 for i in in_a), *(i + 1 for i in in_b)]).tobytes())
        return out


@functools.lru_cache(1)
def _both(definition: str, model: bytes) -> tuple[Both, Known]:
    both = Both(definition, model)
    return both, Known(both.groups)


def align(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """Blocks of texts with their pieces and the groups of each distinct piece, packed; ``groups`` unpacks them per text."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, known = _both(*shared.value)
        for number, rows in enumerate(cut_blocks(batches, "text", BLOCK_BYTES)):
            data, bounds = with_space(*flat(rows.column("text")))
            starts = cuts(data, bounds) if both.cut else np.unique(bounds[:-1][np.diff(bounds) > 0])
            codes, _, values = known.look_up(data, starts)
            flat_values = np.frombuffer(b"".join(values), "<u4")
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
            at = np.cumsum(sizes) - sizes
            n_a, n_b, n_groups = (flat_values[at + k].astype(np.int64) for k in range(3))
            parts = [codes, np.diff(np.searchsorted(starts, bounds)), n_a, n_b, n_groups]
            at = at + 3
            for length in (n_a, n_b, n_groups, n_groups):
                parts.append(gathered(flat_values, at, length))
                at = at + length
            block = rows.column("split")[0].as_py() << 32 | number
            columns = [pa.array([block]), pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([_packed(p)], pa.binary()) for p in parts)], ["block", "doc_ids", *_PARTS])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("split"))
    return texts.mapInArrow(task, _BLOCK)


class _Block:
    """One row of ``align``, unpacked: ``first`` is the first piece of each text, ``ok`` says which texts have tokens."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        codes, docs, n_a, n_b, n_groups, *flats = (_unpacked(row[name]).astype(np.int64) for name in _PARTS)
        self.codes, self.n_a, self.n_b, self.n_groups = codes, n_a, n_b, n_groups
        self.a, self.b, self.a_cuts, self.b_cuts = flats
        self.first = np.concatenate([[0], np.cumsum(docs)])
        bad = np.concatenate([[0], np.cumsum(n_groups[codes] == 0)])
        self.ok = (docs > 0) & (bad[self.first[1:]] == bad[self.first[:-1]])
        self.a_at, self.b_at, self.groups_at = (np.cumsum(n) - n for n in (n_a, n_b, n_groups))

    def links(self) -> np.ndarray:
        """Both ids of each group's last tokens as one number, in the order of the distinct pieces."""
        a = self.a[self.a_cuts - 1 + np.repeat(self.a_at, self.n_groups)]
        return a << 32 | self.b[self.b_cuts - 1 + np.repeat(self.b_at, self.n_groups)]

    def per_text(self, per_piece: np.ndarray) -> np.ndarray:
        """Sums over the pieces of each text, zero where it has no tokens."""
        sums = np.concatenate([[0], np.cumsum(per_piece[self.codes])])[self.first]
        return np.where(self.ok, np.diff(sums), 0)

    def per_piece(self, per_group: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(per_group)])[np.concatenate([self.groups_at, [len(self.a_cuts)]])])

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct links of all texts that have tokens, and how many there are of each."""
        used = np.bincount(self.codes[np.repeat(self.ok, np.diff(self.first))], minlength=len(self.n_groups))
        links, inverse = np.unique(self.links(), return_inverse=True)
        counts = np.bincount(inverse, weights=np.repeat(used, self.n_groups), minlength=len(links)).astype(np.int64)
        return links[counts > 0], counts[counts > 0]

    def listed(self) -> list[bytes]:
        """Of each distinct piece its groups, ids joined by commas, ``|`` between both sides, ``;`` behind each group."""
        data, starts, lengths = _signed_decimals()
        kind_a = np.zeros(len(self.a), np.int64)
        kind_a[self.a_cuts - 1 + np.repeat(self.a_at, self.n_groups)] = 1
        kind_b = np.zeros(len(self.b), np.int64)
        kind_b[self.b_cuts - 1 + np.repeat(self.b_at, self.n_groups)] = 2
        group_a = np.cumsum(kind_a > 0) - (kind_a > 0)
        group_b = np.cumsum(kind_b > 0) - (kind_b > 0)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        tokens = (np.concatenate([self.a, self.b]) * 3 + np.concatenate([kind_a, kind_b]))[order]
        joined = gathered(data, starts[tokens], lengths[tokens]).tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths[tokens])])
        ends = ends[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [joined[a:b] for a, b in zip(ends, ends[1:])]


@functools.lru_cache(1)
def _signed_decimals() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal numbers below 2**17, each with a comma, a bar and a semicolon."""
    texts = [b"%d%b" % (i, sign) for i in range(1 << 17) for sign in (b",", b"|", b";")]
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths


def groups(blocks: DataFrame) -> DataFrame:
    """Per text: both lists of ids, and for each group how many tokens of either list end it or come before."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                for k, doc_id in enumerate(block.doc_ids):
                    codes = block.codes[block.first[k] : block.first[k + 1]] if block.ok[k] else np.zeros(0, np.int64)
                    n_a, n_b, n_groups = block.n_a[codes], block.n_b[codes], block.n_groups[codes]
                    lists = [
                        gathered(block.a, block.a_at[codes], n_a), gathered(block.b, block.b_at[codes], n_b),
                        gathered(block.a_cuts, block.groups_at[codes], n_groups) + np.repeat(np.cumsum(n_a) - n_a, n_groups),
                        gathered(block.b_cuts, block.groups_at[codes], n_groups) + np.repeat(np.cumsum(n_b) - n_b, n_groups),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in lists)],
                        ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"],
                    )

    return blocks.mapInArrow(task, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, a, b, n): the links of each block by pair of ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                links, counts = _Block(row).counted()
                named = [np.full(len(links), row["block"], np.int64), (links >> 32).astype(np.int32), (links & 0xFFFFFFFF).astype(np.int32), counts]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in named], ["block", "a", "b", "n"])

    return blocks.mapInArrow(task, "block long, a int, b int, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n, best): links of all texts by pair of ids, and whether none of the same b has more.

    There are at most as many b as pieces in the vocabulary, so the maxima are a small table.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def digests(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """Numbers of tokens, groups and links per row, what the counts of its links say, and a digest of its groups."""
    # A row is a block, so a batch for Python is bounded by bytes.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    blocks = stage(align(docs, definition, model), "aligned")
    pairs = stage(block_pairs(blocks), "pairs")
    counts = stage(pair_counts(pairs), "pair_counts")
    back = pairs.drop("n").join(counts, ["a", "b"]).groupBy("block").agg(
        F.collect_list("a").alias("pair_a"), F.collect_list("b").alias("pair_b"), F.collect_list("n").alias("pair_n"), F.collect_list("best").alias("pair_best")
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {name: batch.column(name)[k].as_py() for name in ("doc_ids", *_PARTS)}
                block = _Block(row)
                found = [batch.column(f"pair_{c}")[k].values for c in ("a", "b", "n", "best")]
                a, b, n, best = (np.zeros(0, np.int64) if x is None else x.to_numpy(zero_copy_only=False).astype(np.int64) for x in found)
                keys = a << 32 | b
                order = np.argsort(keys)
                links = block.links()
                n_links = block.per_text(block.n_groups)
                sums = []
                for value in (best, n):
                    per_group = np.zeros(len(links), np.int64)
                    if len(keys):
                        # Links of texts without tokens have no count; those texts are not added up.
                        at = order[np.minimum(np.searchsorted(keys[order], links), len(keys) - 1)]
                        per_group = np.where(keys[at] == links, value[at], 0)
                    sums.append(block.per_text(block.per_piece(per_group)))
                listed = block.listed()
                shas = [
                    hashlib.sha256(b"".join([listed[c] for c in block.codes[s:e].tolist()])[:-1]).hexdigest() if ok else ""
                    for s, e, ok in zip(block.first, block.first[1:], block.ok)
                ]
                numbers = [block.per_text(block.n_a), block.per_text(block.n_b), n_links, n_links, *sums]
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), *map(pa.array, numbers), pa.array(shas, pa.string())], names)

    joined = blocks.join(back, "block", "left")
    return joined.mapInArrow(task, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
