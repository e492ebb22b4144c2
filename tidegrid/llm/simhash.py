"""SimHash near-duplicates: fingerprints, exact tiled comparison, and components of linked documents.

1. ``fingerprints``: XXH64 (seed 42) of every word shingle; a bit is set if it is in over half the hashes.
2. ``links``: distinct fingerprints are sorted by the population counts of their halves and cut into tiles. A pair
   of tiles is compared only if their population counts can lie within the radius; in a task, numpy takes the
   exclusive or of all pairs of rows and counts bits, in sub-tiles that are skipped by the same rule on four
   quarters. A task hands on a spanning forest of the links that it found, so a group of copies never makes all
   its pairs, and no link is lost for reachability.
3. ``components``: labels sink to the smallest reachable document, by rounds of joins that halve the distances.

Work in step 2 grows with the square of the number of distinct fingerprints, less what the counts skip; copies of
a fingerprint count once. Nothing of it is collected: tiles are rows that Spark deals out.

Defined cases: null, empty and blank texts have fingerprint zero and link like others; a text with fewer words
than a shingle is one shingle; rows with a null id get a fingerprint and a component of the others, never give a
component its name, and have a null component if no linked row has an id; repeated rows stay; an empty table gives an empty result;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import stage

from .arrays import LOWER, Words, flat, slices

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 32_768
SUBTILE = 512
IS_WORD = np.ones(256, bool)
IS_WORD[9:14] = IS_WORD[32] = False
# Eight lanes of eight bits per byte value: lane i is bit i of the byte.
_LANES = np.array([sum((value >> bit & 1) << 8 * bit for bit in range(8)) for value in range(256)], np.uint64)


def _shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles, and the number of shingles of each text."""
    lengths = words.offsets[1:] - words.offsets[:-1]
    spaced = np.full(len(words.data) + len(words), 32, np.uint8)
    spaced[np.arange(len(words.data)) + np.repeat(np.arange(len(words)), lengths)] = words.data
    starts = words.offsets[:-1] + np.arange(len(words))
    ends = starts + lengths
    per_doc = np.diff(words.docs)
    counts = np.where(per_doc > 0, np.maximum(per_doc - size + 1, 1), 0)
    first = np.repeat(words.docs[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    last = np.minimum(first + size, np.repeat(words.docs[1:], counts)) - 1
    joined, digest = memoryview(spaced), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())), np.uint64, len(first))
    return hashes, counts


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes."""
    bits = np.zeros((len(counts), 64), np.int64)
    if len(hashes):
        # Sums of 255 rows fit the eight-bit lanes.
        chunks = -(-counts // 255)
        doc = np.repeat(np.arange(len(counts)), chunks)
        inner = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        starts = (np.cumsum(counts) - counts)[doc] + inner * 255
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for octet in range(8):
            lanes = np.add.reduceat(_LANES[octets[:, octet]], starts).view(np.uint8).reshape(-1, 8)
            np.add.at(bits[:, 8 * octet : 8 * octet + 8], doc, lanes)
    return np.packbits(bits * 2 > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint's 64 bits as a signed long."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            data, bounds = flat(rows.column("text"))
            found = _majority(*_shingle_hashes(Words(LOWER[data], bounds, IS_WORD), shingle))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, fp long")


def _counts(fps: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of equal parts of the fingerprints, a row each."""
    width = 64 // parts
    mask = np.uint64((1 << width) - 1)
    return np.stack([np.bitwise_count(fps >> np.uint64(width * i) & mask) for i in range(parts)], axis=1).astype(np.int16)


def _apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """Least distance of the population counts of two boxes, summed over the parts."""
    return np.maximum(np.maximum(other_low - high, low - other_high), 0).sum(axis=-1)


class _Forest:
    """Union-find over row numbers."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs within the radius, between two tiles or (right is None) inside one."""
    same = right is None
    right = left if same else right
    boxes = []
    for tile in (left, right):
        counts = _counts(tile, 4)
        at = np.arange(0, len(tile), SUBTILE)
        boxes.append((np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)))
    (low, high), (other_low, other_high) = boxes
    near = _apart(low[:, None], high[:, None], other_low[None], other_high[None]) <= radius
    shift = 0 if same else len(left)
    forest = _Forest(shift + len(right))
    a_out, b_out = [], []
    for i, j in np.argwhere(near).tolist():
        if same and j < i:
            continue
        a, b = left[i * SUBTILE : (i + 1) * SUBTILE], right[j * SUBTILE : (j + 1) * SUBTILE]
        hits = np.bitwise_count(a[:, None] ^ b[None]) <= radius
        if not hits.any():
            continue
        rows, columns = range(i * SUBTILE, i * SUBTILE + len(a)), range(shift + j * SUBTILE, shift + j * SUBTILE + len(b))
        while True:
            # Of the links between rows not yet joined, one per row of the left sub-tile.
            roots, other_roots = np.array([forest.root(x) for x in rows]), np.array([forest.root(y) for y in columns])
            still = hits & (roots[:, None] != other_roots[None])
            found = np.flatnonzero(still.any(axis=1))
            if not len(found):
                break
            for x, y in zip(found.tolist(), still[found].argmax(axis=1).tolist()):
                if forest.join(rows[x], columns[y]):
                    a_out.append(a[x])
                    b_out.append(b[y])
    return np.array(a_out, np.uint64), np.array(b_out, np.uint64)


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) pairs of different fingerprints of ``distinct`` (column fp) whose closure is that of all links."""
    spark = distinct.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(fps):
            counts = _counts(fps, 2)
            low, high = counts.min(axis=0).tolist(), counts.max(axis=0).tolist()
            return pa.RecordBatch.from_pylist([{"tile": xxhash.xxh128_hexdigest(fps.tobytes()), "low0": low[0], "high0": high[0], "low1": low[1], "high1": high[1], "fps": fps.tobytes()}], schema=tiles_schema)

        left = np.zeros(0, np.uint64)
        for batch in batches:
            left = np.concatenate([left, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            while len(left) >= tile:
                yield made(left[:tile])
                left = left[tile:]
        if len(left):
            yield made(left)

    tiles_schema = pa.schema([("tile", pa.string()), *((c, pa.int32()) for c in ("low0", "high0", "low1", "high1")), ("fps", pa.binary())])
    low, high = F.expr("bit_count(fp & 4294967295)"), F.expr("bit_count(shiftrightunsigned(fp, 32))")
    tiles = stage(
        distinct.select("fp").withColumn("c0", low).withColumn("c1", high)
        .repartitionByRange(max(1, distinct.count() // tile), "c0", "c1", "fp")
        .sortWithinPartitions("c0", "c1", "fp").select("fp")
        .mapInArrow(cut, "tile string, low0 int, high0 int, low1 int, high1 int, fps binary"), "tiles",
    )
    # Pairs of tiles meet on a population count of the low half that is in the one's range, widened by the radius.
    left = tiles.select(*(F.col(c).alias(f"a_{c}") for c in ("tile", "low0", "high0", "low1", "high1")))
    left = left.withColumn("at", F.explode(F.sequence(F.col("a_low0") - radius, F.col("a_high0") + radius)))
    right = tiles.select(*(F.col(c).alias(f"b_{c}") for c in ("tile", "low0", "high0", "low1", "high1")))
    right = right.withColumn("at", F.explode(F.sequence("b_low0", "b_high0")))
    apart = [F.greatest(F.col(f"b_low{i}") - F.col(f"a_high{i}"), F.col(f"a_low{i}") - F.col(f"b_high{i}"), F.lit(0)) for i in (0, 1)]
    pairs = (
        left.join(right, "at").where((F.col("a_tile") <= F.col("b_tile")) & (apart[0] + apart[1] <= radius))
        .select("a_tile", "b_tile").distinct()
    )
    fps = tiles.select("tile", "fps")
    loaded = (
        pairs.join(fps.select(F.col("tile").alias("a_tile"), F.col("fps").alias("a_fps")), "a_tile")
        .join(fps.select(F.col("tile").alias("b_tile"), F.col("fps").alias("b_fps")), "b_tile")
    )

    def compare(pair: pa.Table) -> pa.Table:
        a, b = (np.frombuffer(pair.column(c)[0].as_py(), np.uint64) for c in ("a_fps", "b_fps"))
        same = pair.column("a_tile")[0] == pair.column("b_tile")[0]
        found = tile_links(a, None if same else b, radius)
        return pa.table({"a": found[0].view(np.int64), "b": found[1].view(np.int64)})

    # A group is one pair of tiles, so a task holds two tiles at a time.
    return loaded.groupBy("a_tile", "b_tile").applyInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then
    its smaller neighbours. Stars grow over paths, so rounds grow with the logarithm of a component's diameter.
    Neighbours are never gathered in a list: minima are aggregated and joined back, so a hub is split like any key.
    """
    current, before = stage(_larger_first(edges), "edges"), None
    while True:
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # One row per edge at most, so repeats wait for the second step to be dropped.
        large = stage(_directed(large), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        current = stage(_larger_first(small), "edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _directed(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _larger_first(edges: DataFrame) -> DataFrame:
    return _directed(edges).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) per row; component_id is the smallest doc_id reachable over links."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = stage(links(classes, radius, tile), "links")
    reached = components(found).withColumnRenamed("node", "fp")
    # Components are named by a fingerprint first, then by the smallest document of all their fingerprints.
    named = classes.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = stage(named.join(smallest, "component").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def digests(docs: DataFrame) -> DataFrame:
    """Fingerprints as 16 hexadecimal digits."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id, and of rows with that id the first by text.

    Rows without an id cannot be told apart from others of their group by name, and all stay.
    """
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("text")
    number = "row number"
    while number in docs.columns:
        number += "_"
    first = docs.join(kept, "doc_id", "left_semi").withColumn(number, F.row_number().over(order)).where(F.col(number) == 1)
    return first.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
