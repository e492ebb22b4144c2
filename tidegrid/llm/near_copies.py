"""Near copies by SimHash and exact Jaccard similarity of word shingles: of each group of linked rows one stays.

Two texts are linked if their sets of ``SHINGLE``-word shingles (as XXH64, seed 42) have a Jaccard similarity of 0.8 or
more; groups are the closure of links. Fingerprints find most links, prefixes those that fingerprints miss, so no link
is lost to chance:

1. ``fingerprint_pairs``: SimHash fingerprints (as in ``simhash``) within ``RADIUS`` bits give candidates, by the tiled
   comparison of ``simhash.links``; work there grows with the square of the distinct fingerprints. Candidates are linked
   only by their sets. Members of one group are not compared again below.
2. ``shared``: of a set with n hashes the n - ceil(0.8 n) + 1 smallest are its prefix. Linked sets share a hash of
   their prefixes. Prefixes travel packed, dealt by hash; only hashes that two different sets have become rows.
   Hashes with the same members count once.
3. ``stars``: every member is compared with the smallest member of each of its hashes, so that large groups of
   copies are linked by a number of pairs that grows with their rows. Histograms of the sets go first, as their
   distance bounds the difference of the sets; whole sets are loaded only for what they do not rule out.
4. ``candidates``: members of a hash that are not linked yet are cut into tiles of histograms, and pairs of tiles are
   dealt out as rows. Nodes that the histograms may link form blocks, so a node counts once for all its hashes.
5. ``rest``: the sets of each block are compared in tiles likewise. A task hands on a spanning forest, so no group
   makes all its pairs. Tiles of sets over ``INLINE_BYTES`` lie in files of the staging folder, written once; their pairs
   travel as paths, so no such tile is copied for each of its pairs or read by the JVM. Failed attempts leave files behind.

Equal sets are one node throughout. Work in steps 4 and 5 grows with the square of the sets that share a passage without
being near copies; it is dealt out.

Defined cases: null, empty and blank texts are copies of each other; a text with fewer words than a shingle is one
shingle; of a group the row with the smallest doc_id stays, of equal ids that of the smallest text hash, rows without
id last; rows with equal ids and texts are one row; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import small_side, stage, staging_path

from . import files
from .arrays import LOWER, Words, flat, give_back, slices
from .simhash import IS_WORD, SEED, _Forest, _majority, _shingle_hashes, components, links

SHINGLE = 5
# Fingerprints of sets at the threshold differ in 9.7 of 64 bits on average: 64 / pi times the arc cosine of 8 / 9.
RADIUS = 10
BINS = 256
TILE = 256
# Prefix hashes that a task packs at a time, and bytes of text for which there is one more bucket.
PACKED = 1 << 18
BUCKET_BYTES = 4 << 20
BUCKETS = 512
BATCH_BYTES = "8m"
# Bytes of sets up to which a tile travels in its row; pairs of tiles that a task gets where they are paths.
INLINE_BYTES = 512 << 10
TASK_PAIRS = 16
# Nodes whose links a task joins before it hands them on.
FOREST_NODES = 1 << 18
TILE_COLUMNS = {"nodes": "node", "components": "component", "sizes": "size", "contents": "content"}


def linked(common: int, total: int) -> bool:
    """Similarity of 0.8 or more, from the size of the intersection and the sum of both sizes."""
    return 5 * common >= 4 * (total - common)


def _hashes(rows: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = flat(rows.column("text"))
    return _shingle_hashes(Words(LOWER[data], bounds, IS_WORD), size)


def _distinct(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return [np.unique(part) for part in np.split(hashes, np.cumsum(counts)[:-1])]


def _sets(rows: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    return _distinct(*_hashes(rows, size))


def _name(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


def _bins(found: np.ndarray) -> bytes:
    """Histogram of a set, cut off at 255 a bin, which brings no two of them further apart."""
    return np.minimum(np.bincount((found % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def _near(apart: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether sets can be linked: they differ in at most a ninth of the sum of their sizes, histograms in no more."""
    return 9 * apart <= total


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a task; after the last one the worker gives its unused memory back, as it outlives the task."""
    yield from slices(batches, "text")
    give_back()


def _keys() -> list[Column]:
    """What names a row, in the order in which rows stay."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("key_text")]


def nodes(docs: DataFrame, size: int) -> DataFrame:
    """(no_id, key_id, key_text, node, size, bins, fp) per row; node names the set, bins is its histogram, fp the text's fingerprint."""
    names = ["no_id", "key_id", "key_text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches):
            hashes, counts = _hashes(rows, size)
            sets, prints = _distinct(hashes, counts), _majority(hashes, counts)
            found = np.array([_name(s) for s in sets], np.uint64).view(np.int64)
            made = [pa.array(found), pa.array([len(s) for s in sets], pa.int32()), pa.array([_bins(s) for s in sets], pa.binary()), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *made], [*names, "node", "size", "bins", "fp"])

    return docs.select(*_keys(), "text").mapInArrow(task, "no_id boolean, key_id long, key_text long, node long, size int, bins binary, fp long")


def fingerprint_pairs(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b) pairs of nodes whose closure is that of all fingerprints within ``radius`` bits."""
    # Texts of one set may repeat shingles differently; the set then goes by the smallest fingerprint.
    prints = stage(rows.groupBy("node").agg(F.min("fp").alias("fp")), "prints")
    classes = stage(prints.groupBy("fp").agg(F.min("node").alias("least")), "print_classes")
    found = links(classes, radius)
    between = found.join(classes.toDF("a", "left"), "a").join(classes.toDF("b", "right"), "b").select(F.col("left").alias("a"), F.col("right").alias("b"))
    equal = prints.join(classes, "fp").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return stage(equal.unionByName(between).distinct(), "fingerprint_pairs")


def shared(docs: DataFrame, size: int) -> DataFrame:
    """(hash, node) for prefix hashes that are in the prefixes of two or more different sets."""
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, length // BUCKET_BYTES)

    def packed(hashes: list, names: list) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.stack([np.concatenate(hashes), np.concatenate(names)], axis=1), axis=0)
        at = (pairs[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        pairs, at = pairs[order], at[order]
        used, starts = np.unique(at, return_index=True)
        parts = [part.tobytes() for part in np.split(pairs, starts[1:])]
        for k in range(0, len(used), 64):
            yield pa.RecordBatch.from_arrays([pa.array(used[k : k + 64]), pa.array(parts[k : k + 64], pa.binary())], ["bucket", "pairs"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names, held = [], [], 0
        for rows in _parts(batches):
            for found in _sets(rows, size):
                if len(found):
                    prefix = found[: len(found) + (-4 * len(found) // 5) + 1]
                    hashes.append(prefix)
                    names.append(np.full(len(prefix), _name(found), np.uint64))
                    held += len(prefix)
            if held >= PACKED:
                yield from packed(hashes, names)
                hashes, names, held = [], [], 0
        if held:
            yield from packed(hashes, names)

    def repeats(bucket: pa.Table) -> pa.Table:
        pairs = np.concatenate([np.frombuffer(p.as_py(), np.uint64).reshape(-1, 2) for p in bucket.column("pairs")])
        pairs = np.unique(pairs, axis=0)
        _, inverse, counts = np.unique(pairs[:, 0], return_inverse=True, return_counts=True)
        pairs = pairs[counts[inverse] > 1]
        return pa.table({"hash": pairs[:, 0].copy().view(np.int64), "node": pairs[:, 1].copy().view(np.int64)})

    blocks = docs.select("text").mapInArrow(pack, "bucket long, pairs binary")
    found = stage(blocks.groupBy("bucket").applyInArrow(repeats, "hash long, node long"), "shared")
    groups = found.groupBy("hash").agg(
        F.min("node").alias("least"), F.max("node").alias("most"), F.count("*").alias("members"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("all")
    )
    once = groups.groupBy("least", "most", "members", "all").agg(F.min("hash").alias("hash"))
    return stage(found.join(once.select("hash", "least", "members"), "hash"), "members")


def contents(docs: DataFrame, rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, hashes): the sets of the nodes in ``wanted``, each from one row that has it."""
    first = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("no_id", "key_id", "key_text")).alias("k")).select("k.*")
    texts = docs.select(*_keys(), "text").join(small_side(stage(first, "texts")), ["no_id", "key_id", "key_text"], "left_semi")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            found = _sets(part, size)
            names = np.array([_name(s) for s in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([s.tobytes() for s in found], pa.binary())], ["node", "hashes"])

    return stage(texts.select("text").mapInArrow(task, "node long, hashes binary").dropDuplicates(["node"]), "sets")


def star_pairs(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b) pairs of a member and the smallest member of a hash that ``groups`` (node, component) has apart."""
    pairs = members.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    named = pairs.join(groups.toDF("a", "a_group"), "a", "left").join(groups.toDF("b", "b_group"), "b", "left")
    return named.where("coalesce(a_group, a) != coalesce(b_group, b)").select("a", "b")


def possible(pairs: DataFrame, sketches: DataFrame, name: str) -> DataFrame:
    """``pairs`` that their histograms do not rule out; nodes without a sketch share no prefix, so they have no link."""
    loaded = pairs.join(sketches.toDF("a", "a_size", "a_bins"), "a").join(sketches.toDF("b", "b_size", "b_bins"), "b")
    loaded = loaded.where("5 * least(a_size, b_size) >= 4 * greatest(a_size, b_size)")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            left, right = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("a_bins", "b_bins"))
            total = rows.column("a_size").to_numpy(zero_copy_only=False) + rows.column("b_size").to_numpy(zero_copy_only=False)
            yield rows.select(["a", "b"]).filter(pa.array(_near(np.abs(left - right).sum(axis=1), total)))

    return stage(loaded.select("a", "b", "a_size", "b_size", "a_bins", "b_bins").mapInArrow(task, "a long, b long"), name)


def stars(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs``."""
    loaded = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for left, right in zip(rows.column("left"), rows.column("right")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                keep.append(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)))
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return loaded.select("a", "b", "left", "right").mapInArrow(task, "a long, b long")


def tile_links(left: list, right: list | None) -> list[tuple[int, int]]:
    """Spanning forest of the links between two tiles or (right is None) inside one; a tile lists (node, group, set)."""
    rows = left if right is None else left + right
    shift = 0 if right is None else len(left)
    forest, seen = _Forest(len(rows)), {}
    for x, (_, group, _) in enumerate(rows):
        forest.join(seen.setdefault(group, x), x)
    bins = np.stack([np.frombuffer(_bins(s), np.uint8) for *_, s in rows]).astype(np.int16)
    sizes = np.array([len(s) for *_, s in rows])
    out = []
    for x in range(len(left)):
        start = x + 1 if right is None else shift
        apart = np.abs(bins[start:] - bins[x]).sum(axis=1)
        for y in (np.flatnonzero(_near(apart, sizes[start:] + sizes[x])) + start).tolist():
            if forest.root(x) != forest.root(y) and linked(len(np.intersect1d(rows[x][2], rows[y][2], assume_unique=True)), int(sizes[x] + sizes[y])):
                forest.join(x, y)
                out.append((rows[x][0], rows[y][0]))
    return out


def tile_candidates(left: list, right: list | None) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of different groups that the histograms do not rule out; a tile lists (node, group, (size, bins))."""
    rows = left if right is None else left + right
    shift = 0 if right is None else len(left)
    groups, sizes = np.array([g for _, g, _ in rows], np.int64), np.array([z for *_, (z, _) in rows], np.int64)
    bins = np.stack([np.frombuffer(b, np.uint8) for *_, (_, b) in rows]).astype(np.int16)
    forest, out = _Forest(len(rows)), []
    for x in range(len(left)):
        start = x + 1 if right is None else shift
        near = _near(np.abs(bins[start:] - bins[x]).sum(axis=1), sizes[start:] + sizes[x]) & (groups[start:] != groups[x])
        out += [(rows[x][0], rows[y][0]) for y in (np.flatnonzero(near) + start).tolist() if forest.join(x, y)]
    return out


def _tile_pairs(rows: DataFrame, name: str, tile: int, inline: int | None = None) -> DataFrame:
    """Rows (hash, node, component, size, content) of each hash as tiles; (hash, part, other, a, b) pairs of tiles of a hash.

    A tile with more than ``inline`` bytes of content is a file, and its lists are empty.
    """
    counts = rows.groupBy("hash").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    cut = rows.join(counts, "hash").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    folder = staging_path(rows.sparkSession, f"{name}_files")

    def pack(table: pa.Table) -> pa.Table:
        kinds = {"nodes": pa.int64(), "components": pa.int64(), "sizes": pa.int32(), "contents": pa.binary()}
        path = None
        if inline is not None and pc.sum(pc.binary_length(table.column("content"))).as_py() > inline:
            path, sink = f"{folder}/{uuid.uuid4().hex}", pa.BufferOutputStream()
            content = table.select(list(TILE_COLUMNS.values()))
            with pa.ipc.new_stream(sink, content.schema) as out:
                out.write_table(content)
            files.write(path, sink.getvalue())
        lists = {c: pa.array([[] if path else table.column(source).to_pylist()], pa.list_(kinds[c])) for c, source in TILE_COLUMNS.items()}
        own = {c: table.column(c).combine_chunks()[:1] for c in ("hash", "part", "parts")}
        return pa.table({**own, "members": pa.array([len(table)], pa.int32()), "path": pa.array([path], pa.string()), **lists})

    schema = (
        "hash long, part int, parts int, members int, path string, "
        "nodes array<long>, components array<long>, sizes array<int>, contents array<binary>"
    )
    tiles = stage(cut.select("hash", "part", "parts", "node", "component", "size", "content").groupBy("hash", "part", "parts").applyInArrow(pack, schema), name)
    content = F.struct("path", *TILE_COLUMNS)
    a = tiles.select("hash", "part", "members", F.explode(F.sequence("part", F.col("parts") - 1)).alias("other"), content.alias("a"))
    b = tiles.select("hash", F.col("part").alias("other"), content.alias("b"))
    pairs = a.join(b, ["hash", "other"]).where("part != other OR members > 1").select("hash", "part", "other", "a", "b")
    if inline is None:
        return pairs
    # Paths are short and the work behind them is not: such pairs are dealt out by number, as adaptive execution goes by bytes.
    stored = F.col("a.path").isNotNull() | F.col("b.path").isNotNull()
    number = tiles.where("path IS NOT NULL").agg(F.sum("parts")).first()[0] or 0
    return pairs.where(~stored).unionByName(pairs.where(stored).repartition(max(1, number // TASK_PAIRS)))


def _each_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list | None]]:
    def listed(row: pa.StructScalar) -> list:
        if path := row["path"].as_py():
            table = pa.ipc.open_stream(files.read(path)).read_all()
            nodes, components, sizes = (table.column(c).to_pylist() for c in ("node", "component", "size"))
            contents = [x.as_buffer() for x in table.column("content")]
        else:
            nodes, components, sizes, contents = (row[c].as_py() for c in TILE_COLUMNS)
        return [(n, c, (z, x)) for n, c, z, x in zip(nodes, components, sizes, contents)]

    for batch in batches:
        for k in range(len(batch)):
            same = batch.column("part")[k] == batch.column("other")[k]
            yield batch.column("hash")[k].as_py(), listed(batch.column("a")[k]), None if same else listed(batch.column("b")[k])


def forests(found: Iterator[list[tuple[int, int]]], limit: int = FOREST_NODES) -> Iterator[pa.RecordBatch]:
    """Pairs of a task as stars around the smallest node: a node goes out once, however many pairs of tiles it was found in."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def joined() -> pa.RecordBatch:
        ends = [(x, root(x)) for x in parent]
        ends = [(x, y) for x, y in ends if x != y]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([y for _, y in ends], pa.int64())], ["a", "b"])

    for pairs in found:
        for pair in pairs:
            for end in pair:
                parent.setdefault(end, end)
            x, y = map(root, pair)
            parent[max(x, y)] = min(x, y)
        if len(parent) >= limit:
            yield joined()
    if parent:
        yield joined()


def candidates(members: DataFrame, sketches: DataFrame, groups: DataFrame, tile: int) -> DataFrame:
    """(hash, node, component, size) of members that may be linked with one that ``groups`` (node, component) has apart.

    hash names a block here: nodes that such pairs connect. Each node is in one block, however many hashes it shares.
    """
    grouped = members.where("members > 2").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = grouped.groupBy("hash").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("hash")
    # The smallest member has been compared with all others.
    left = grouped.where("node != least").join(split, "hash", "left_semi").join(sketches, "node").select("hash", "node", "component", "size", F.col("bins").alias("content"))
    left = stage(left, "apart")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return forests(tile_candidates(*tiles) for _, *tiles in _each_pair(batches))

    reached = components(_tile_pairs(left, "sketch_tiles", tile).mapInArrow(task, "a long, b long")).toDF("node", "hash")
    blocks = reached.unionByName(reached.select(F.col("hash").alias("node"), "hash").distinct())
    known = sketches.select("node", "size").join(blocks, "node").join(groups, "node", "left")
    return stage(known.select("hash", "node", F.coalesce("component", "node").alias("component"), "size"), "candidates")


def rest(blocks: DataFrame, sets: DataFrame, tile: int, inline: int = INLINE_BYTES) -> DataFrame:
    """(a, b) links between candidates of a block, as spanning forests."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, *tiles in _each_pair(batches):
            a, b = ([(n, c, np.frombuffer(x, np.uint64)) for n, c, (_, x) in t] if t else None for t in tiles)
            found = tile_links(a, b)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    loaded = blocks.join(sets.withColumnRenamed("hashes", "content"), "node")
    return _tile_pairs(loaded, "set_tiles", tile, inline).mapInArrow(task, "a long, b long")


def keep_one(docs: DataFrame, size: int = SHINGLE, tile: int = TILE, inline: int = INLINE_BYTES, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near copies."""
    # Rows with sets or tiles are large, so a batch for Python is bounded by bytes.
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    keys = ["no_id", "key_id", "key_text"]
    rows = stage(nodes(docs, size), "nodes")
    members = shared(docs, size)
    sketches = rows.join(members.select("node").distinct(), "node", "left_semi").select("node", "size", "bins").dropDuplicates(["node"])
    sketches = stage(sketches, "sketches")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        left = possible(pairs, sketches, f"{name}_pairs")
        ends = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return stage(stars(left, contents(docs, rows, ends, size)), f"{name}_links")

    near = verified(fingerprint_pairs(rows, radius), "print")
    near = near.unionByName(verified(star_pairs(members, components(near)), "star"))
    blocks = candidates(members, sketches, components(near), tile)
    more = stage(rest(blocks, contents(docs, rows, blocks.select("node").distinct(), size), tile, inline), "more_links")
    groups = components(near.unionByName(more))
    named = rows.select(*keys, "node").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = stage(named.groupBy("component").agg(F.min(F.struct(*keys)).alias("k")).select("k.*"), "survivors")
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    kept = docs.select(*_keys(), row).join(first, keys, "left_semi").dropDuplicates(keys)
    return kept.select(*(F.col(f"row.`{name}`").alias(name) for name in docs.columns))
