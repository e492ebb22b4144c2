"""Trie of conversations by their turns, built as a burst trie.

1. ``ordered``: turns are dealt out by ranges of (conversation, turn), numbered within each range, and shifted by the
   counts of the ranges before, so a conversation of any length is split over tasks. A turn's id is 16 bytes of the
   SHA-256 of its role and text.
2. ``distinct_sequences``: equal conversations are one sequence with a count of members. The key of a sequence is 128 bits
   of hashes over its numbered turns, which are combined before the shuffle. Members' ids are listed by tasks in parts and
   hashed part by part, as SHA-256 goes through its input in order.
3. ``burst``: all suffixes start in one container under the root. A container with more than ``LIMIT`` turns of more than
   one sequence bursts: its suffixes go to containers under the next turn id, and its head becomes an inner node.
   Sequences that end at the head stay there. Rounds go on while a container is too large; a round reads the turns
   of one position only.
4. Containers that remain are swept: a shard (a task) holds its containers one after the other, sorts the suffixes of each and
   makes a node wherever neighbours part. A container of one sequence is a chain, and its nodes are its rows. Inner nodes
   get their numbers from the heads below them.

Rounds grow with the depth to which more than ``LIMIT`` turns share a path, not with the number of conversations.

Defined cases: rows without conv_id belong to no conversation; a null turn comes first, equal turns are ordered by the id
of the turn, repeated rows are turns of their own; null role or text is empty; an empty table has no nodes, not even a root;
columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import stage

# Turns in a container that is swept at once.
LIMIT = 50_000
ROOT = b"\0" * 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
# Bytes of listed ids in one part.
LISTED = 1 << 20
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "head binary, parent binary"
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(*parts: Column) -> Column:
    """16 bytes that name these bytes."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, size, run): turns numbered from 1, code points of each, and of all up to it."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    name = _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"), name.alias("turn"), F.length(text).cast("long").alias("size")
    )
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("at"), F.col("turn")]
    dealt = stage(turns.repartitionByRange(parts, "conv_id", *order).withColumn("slice", F.spark_partition_id()), "turns")
    # At most one row per task and conversation.
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("conv_id", "slice").agg(F.count("*").alias("n"), F.sum("size").alias("s")).select(
        "conv_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s")
    )
    within = Window.partitionBy("conv_id", "slice").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = dealt.select("*", F.row_number().over(within).alias("k"), F.sum("size").over(running).alias("r"))
    return numbered.join(shifts, ["conv_id", "slice"]).select(
        "conv_id", (F.col("k") + F.col("n")).alias("pos"), "turn", "size", (F.col("r") + F.col("s")).alias("run")
    )


def rebuilt(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first conversation of their family of ids.

    h is the CRC-32 of the decimal id modulo ``most``: h turns come from there (fewer if it has fewer, none if there is no such
    conversation), then the own turns after the first h. Gives (conv_id, pos, turn, size, after), ``after`` being
    the code points from that turn to the end, and (conv_id) of all conversations, as some have no turn.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    own = turns.select("*", h)
    whole = own.groupBy("conv_id", "h").agg(F.sum("size").alias("total"), F.coalesce(F.sum(F.when(F.col("pos") > F.col("h"), F.col("size"))), F.lit(0)).alias("tail"))
    # At most ``most`` - 1 turns a row.
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "turn", "size"))).alias("first")
    )
    taken = F.when(F.col("first").isNull(), F.array().cast("array<struct<pos:bigint,turn:binary,size:bigint>>")).otherwise(F.slice("first", F.lit(1), F.col("h").cast("int")))
    known = whole.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base", "left").select("conv_id", "h", "total", "tail", taken.alias("taken"))
    known = stage(known, "families")
    rest = F.aggregate(F.slice("taken", F.col("pos").cast("int"), F.size("taken")), F.lit(0).cast("long"), lambda s, t: s + t["size"])
    heads = known.select("*", F.explode("taken").alias("t")).select("conv_id", "tail", "taken", "t.*")
    heads = heads.select("conv_id", "pos", "turn", "size", (rest + F.col("tail")).alias("after"))
    tails = turns.join(known.select("conv_id", "h", "total", F.size("taken").alias("k")), "conv_id").where("pos > h")
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn", "size", (F.col("total") - F.col("run") + F.col("size")).alias("after"))
    return heads.unionByName(tails), known.select("conv_id")


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, conv_id) in order as parts (rep, first, ids): ids in decimal, joined by commas."""
    rep, first, held, size, out = None, None, [], 0, []

    def made() -> pa.RecordBatch:
        columns = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["rep", "first", "ids"])

    for batch in batches:
        for group, conv_id in zip(batch.column("rep").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (group != rep or size >= LISTED):
                out.append((rep, first, ",".join(held).encode()))
                held, size = [], 0
            if not held:
                rep, first = group, conv_id
            held.append(str(conv_id))
            size += len(held[-1]) + 1
        if out:
            yield made()
            out = []
    if held:
        out.append((rep, first, ",".join(held).encode()))
        yield made()


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order as one SHA-256 per rep."""
    rep, state = None, None
    for batch in batches:
        out = []
        for group, ids in zip(batch.column("rep").to_pylist(), batch.column("ids").to_pylist()):
            if group != rep:
                if state:
                    out.append((rep, state.hexdigest()))
                rep, state = group, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int64()), pa.array([h for _, h in out])], ["rep", "ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([state.hexdigest()])], ["rep", "ends"])


def distinct_sequences(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(rep, n, len, ends): per distinct sequence its smallest conversation, members, length and the digest of the members' ids."""
    key = ["len", "key_a", "key_b"]
    made = turns.groupBy("conv_id").agg(
        F.count("*").alias("len"), *(F.bit_xor(F.xxhash64(F.lit(k), "pos", "turn")).alias(name) for k, name in enumerate(key[1:]))
    )
    members = stage(conversations.join(made, "conv_id", "left").fillna(0, key), "members")
    groups = stage(members.groupBy(*key).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")), "sequences")
    many = members.join(groups.where("n > 1"), key).select("rep", "conv_id")
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = many.repartitionByRange(parts, "rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(listed, "rep long, first long, ids binary")
    ends = lists.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(hashed, "rep long, ends string")
    alone = F.sha2(F.col("rep").cast("string").cast("binary"), 256)
    return groups.join(ends, "rep", "left").select("rep", "n", "len", F.coalesce("ends", alone).alias("ends"))


def burst(sequences: DataFrame, turns: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Suffixes in their containers, and the heads that burst.

    (rep, n, len, ends, head, depth, path, size, others): path lists the inner nodes above the head, size is that of the head's
    last turn, others the sequences of its container, null if the sequence ends at an inner node, its head.
    (head, path, depth, size) of inner nodes.
    """
    # Written, so that the head is a column like any other in the joins below.
    state = stage(sequences.select(
        "*", F.lit(ROOT).alias("head"), F.lit(0).alias("depth"), F.array().cast("array<binary>").alias("path"), F.lit(0).cast("long").alias("size")
    ), "distinct")
    settled, inner, depth = [], [], 0
    while True:
        sums = state.groupBy("head").agg(F.count("*").alias("others"), F.sum(F.col("len") - depth).alias("left"), F.first("path").alias("path"), F.first("size").alias("size"))
        sizes = stage(sums, "containers")
        large = (F.col("others") > 1) & (F.col("left") > limit)
        held = state.join(sizes.select("head", "others", large.alias("large")), "head")
        columns = [*state.columns, "others"]
        settled.append(held.where("NOT large").select(columns))
        big = sizes.where(large)
        if big.isEmpty():
            break
        inner.append(big.select("head", "path", F.lit(depth).alias("depth"), "size"))
        settled.append(held.where(f"large AND len = {depth}").withColumn("others", F.lit(None).cast("long")).select(columns))
        step = turns.where(F.col("pos") == depth + 1).select(F.col("conv_id").alias("rep"), "turn", F.col("size").alias("step"))
        moved = held.where(f"large AND len > {depth}").join(step, "rep")
        depth += 1
        state = stage(moved.select(
            "rep", "n", "len", "ends", _digest("head", "turn").alias("head"), F.lit(depth).alias("depth"), F.concat("path", F.array("head")).alias("path"), F.col("step").alias("size"),
        ), "burst")
    every = settled[0]
    for part in settled[1:]:
        every = every.unionByName(part)
    nodes = None
    for part in inner:
        nodes = part if nodes is None else nodes.unionByName(part)
    return every, nodes


def _sweep(head: tuple, suffixes: list[tuple]) -> list[tuple]:
    """Nodes of one container; head is (key, parent key, depth, size), a suffix (turns, sizes, rep, n, ends)."""
    key, parent_key, depth, size = head
    suffixes.sort(key=lambda s: s[0])
    parent, depths, sizes, convs, counts, ends = [-1], [depth], [size], [None], [0], [EMPTY_SHA]
    path, before = [0], []
    for turns, lengths, rep, n, digest in suffixes:
        same = 0
        for x, y in zip(before, turns):
            if x != y:
                break
            same += 1
        del path[same + 1 :]
        for length in lengths[same:]:
            parent.append(path[-1])
            depths.append(depth + len(path))
            sizes.append(length)
            convs.append(None)
            counts.append(0)
            ends.append(EMPTY_SHA)
            path.append(len(parent) - 1)
        convs[path[-1]], counts[path[-1]], ends[path[-1]] = rep, n, digest
        before = turns
    children, leaves, saved = [0] * len(parent), [0] * len(parent), [0] * len(parent)
    # Children come behind their parents.
    for k in range(len(parent) - 1, -1, -1):
        leaves[k] = leaves[k] or 1
        saved[k] += (counts[k] - 1) * sizes[k]
        up = parent[k]
        if up >= 0:
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
            counts[up] += counts[k]
            convs[up] = convs[k] if convs[up] is None else min(convs[up], convs[k])
    return [
        (convs[k], depths[k], convs[parent[k]] if k else None, counts[k], children[k], leaves[k], saved[k], ends[k], None if k else key, None if k else parent_key)
        for k in range(len(parent))
    ]


def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard in the order of (head, rep, pos) as nodes."""
    types = [*[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary()]
    names = [part.strip().split(" ")[0] for part in _NODE.split(",")]
    head, suffixes, last, out = None, [], None, []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("head", "parent", "depth", "head_size", "rep", "n", "ends", "turn", "size")]
        for key, parent, depth, head_size, rep, n, ends, turn, size in zip(*columns):
            if head is None or key != head[0]:
                if head:
                    out += _sweep(head, suffixes)
                head, suffixes, last = (key, parent, depth, head_size), [], None
            if rep != last:
                suffixes.append(([], [], rep, n, ends))
                last = rep
            if turn is not None:
                suffixes[-1][0].append(turn)
                suffixes[-1][1].append(size)
            if len(out) >= 10_000:
                yield made()
                out = []
    if head:
        out += _sweep(head, suffixes)
    if out:
        yield made()


def container_nodes(suffixes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of all containers; heads carry their key and their parent's."""
    rows = turns.select(F.col("conv_id").alias("rep"), "pos", "turn", F.col("size").alias("size"), "after")
    placed = suffixes.where("others IS NOT NULL").withColumnRenamed("size", "head_size").withColumn("parent", F.try_element_at("path", F.lit(-1))).drop("path")
    held = stage(placed.join(rows, (placed["rep"] == rows["rep"]) & (rows["pos"] > placed["depth"]), "left").drop(rows["rep"]), "suffixes")

    one = held.where("others = 1")
    at_top = F.col("pos").isNull() | (F.col("pos") == F.col("depth") + 1)
    shared, last = F.col("n") - 1, F.col("pos") == F.col("len")
    none = F.lit(None).cast("binary")
    fields = [name for name in COLUMNS] + ["head", "parent"]

    def node(*values: Column) -> Column:
        return F.struct(*(v.alias(name) for v, name in zip(values, fields)))

    top = node(
        F.col("rep"), F.col("depth").cast("long"), F.lit(None).cast("long"), F.col("n"), F.col("pos").isNotNull().cast("long"), F.lit(1).cast("long"),
        shared * (F.coalesce("after", F.lit(0)) + F.col("head_size")), F.when(F.col("pos").isNull(), F.col("ends")).otherwise(EMPTY_SHA), F.col("head"), F.col("parent"),
    )
    below = node(
        F.col("rep"), F.col("pos").cast("long"), F.col("rep"), F.col("n"), (~last).cast("long"), F.lit(1).cast("long"), shared * F.col("after"),
        F.when(last, F.col("ends")).otherwise(EMPTY_SHA), none, none,
    )
    wanted = F.filter(F.array(F.when(at_top, top), F.when(F.col("pos").isNotNull(), below)), lambda x: x.isNotNull())
    chains = one.select(F.explode(wanted).alias("node")).select("node.*")
    shards = held.where("others > 1").repartition("head").sortWithinPartitions("head", "rep", "pos")
    return chains.unionByName(shards.select("head", "parent", "depth", "head_size", "rep", "n", "ends", "turn", "size").mapInArrow(swept, _NODE))


def inner_nodes(suffixes: DataFrame, inner: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes of the heads that burst, with their key and that of their parent; heads are the nodes of the containers below.

    An inner node is above at least ``LIMIT`` turns, so these tables are small beside the turns.
    """
    places = suffixes.where("others IS NOT NULL").groupBy("head").agg(F.first("path").alias("path"))
    ended = suffixes.where("others IS NULL")
    below = heads.join(places, "head").select("path", "conv_id", "n_convs", "n_leaves", "saved_tokens")
    at_end = ended.select(F.concat("path", F.array("head")).alias("path"), F.col("rep").alias("conv_id"), F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    sums = below.unionByName(at_end).select(F.explode("path").alias("head"), "conv_id", "n_convs", "n_leaves", "saved_tokens").groupBy("head").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")
    )
    known = stage(inner.join(sums, "head").withColumn("parent", F.try_element_at("path", F.lit(-1))), "inner")
    own = known.select(F.explode(F.concat("path", F.array("head"))).alias("head"), ((F.col("n_convs") - 1) * F.col("size")).alias("own")).groupBy("head").agg(F.sum("own").alias("own"))
    children = heads.select("parent").unionByName(known.select("parent")).where("parent IS NOT NULL").groupBy(F.col("parent").alias("head")).agg(F.count("*").alias("n_children"))
    full = known.join(own, "head").join(children, "head").join(ended.select("head", "ends"), "head", "left")
    return full.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("saved") + F.col("own")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"), "head", "parent",
    )


def nodes(turns: DataFrame, conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All nodes of the trie of conversations, given their turns (conv_id, pos, turn, size, after) and their ids."""
    turns = stage(turns, "rebuilt")
    suffixes, inner = burst(distinct_sequences(turns, conversations), turns, limit)
    if inner is None:
        return container_nodes(suffixes, turns).select(COLUMNS)
    suffixes = stage(suffixes, "settled")
    below = stage(container_nodes(suffixes, turns), "nodes")
    heads = below.where("head IS NOT NULL")
    upper = stage(inner_nodes(suffixes, inner, heads), "upper")
    parents = upper.select(F.col("head").alias("parent"), F.col("conv_id").alias("above"))
    named = heads.unionByName(upper).join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return below.where("head IS NULL").select(COLUMNS).unionByName(named.select(COLUMNS))


def family_trie(conversations: DataFrame, family: int = 100, most: int = 6, limit: int = LIMIT) -> DataFrame:
    """The trie of ``conversations`` rebuilt by families of ids."""
    turns, ids = rebuilt(stage(ordered(conversations), "ordered"), family, most)
    return nodes(turns, ids, limit)
