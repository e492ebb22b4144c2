import hashlib
import random
import zlib

import duckdb
import pytest

from tidegrid.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, head string"


def brute(rows, family=100, most=6):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(conv, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        whole = own.get(c - c % family, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves = sum(totals[p][0] for p in below) or 1
        saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0) + sum(totals[p][1] for p in below)
        totals[path] = leaves, saved
    out = []
    for path, found in members.items():
        ends = ",".join(map(str, sorted(c for c, last in found if last)))
        parent = min(c for c, _ in members[path[:-1]]) if path else None
        out.append((min(c for c, _ in found), len(path), parent, len(found), len(children.get(path, [])), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)


def check(spark, rows, limit, **options):
    got = prefix_trie.family_trie(frame(spark, rows), limit=limit, **options)
    assert got.columns == prefix_trie.COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, **options)


@pytest.mark.parametrize("limit", [0, 6, 50_000])
def test_equal_to_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = []
    for c in [*range(0, 230, 3), 7000, 7001, 7002, 7050]:
        length = rng.choice([0, 1, 2, 5, 9])
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "é🙂", "long text"])) for t in range(length)]
    # One conversation with many copies, one with a copy that goes on, repeated rows, rows of no conversation.
    for c in range(9000, 9040):
        rows += [(c, t, "user", f"same {t}") for t in range(8 + (c == 9013))]
    rows += [(c, t, "user", "x") for c in (50_001, 50_002) for t in (1, 1, None)]
    rows += [(None, 0, "user", "x"), (None, None, None, None)]
    check(spark, rows, limit)


def test_one_conversation_and_one_without_turns(spark):
    absent = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 >= 2)
    check(spark, [(0, 0, "user", "héllo")], 0)
    check(spark, [(absent, 0, "user", "gone")], 0)
    check(spark, [(absent, 0, "user", "gone"), (0, 0, "user", "one"), (absent + 1000, 0, "u", "a")], 0)
    check(spark, [(5, k % 3, None, None) for k in range(6)], 2)


def test_other_families(spark):
    rows = [(c, t, "user", f"{c % 4} {t}") for c in range(40) for t in range(4)]
    check(spark, rows, 20, family=10, most=3)


def test_no_rows(spark):
    assert prefix_trie.family_trie(frame(spark, [], 1)).collect() == []


def test_long_conversation_is_split(spark):
    rows = [(200, t, "user", str(t)) for t in range(4000)] + [(c, t, "user", str(t)) for c in range(201, 210) for t in range(3)]
    numbered = prefix_trie.ordered(frame(spark, rows))
    assert numbered.where("conv_id = 200").agg({"pos": "max", "run": "max"}).first()[:] == (4000, sum(len(str(t)) for t in range(4000)))
    check(spark, rows, 100)


def test_ids_are_listed_in_parts(spark, monkeypatch):
    rows = [(r, c) for r in (1, 2, 5) for c in range(r * 10, r * 10 + 300)]
    parts = spark.createDataFrame(rows, "rep long, conv_id long").coalesce(1).sortWithinPartitions("rep", "conv_id")
    monkeypatch.setattr(prefix_trie, "LISTED", 50)
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pandas(parts.toPandas())]
    made = list(prefix_trie.listed(iter(batches)))
    assert sum(len(b) for b in made) > 30
    got = {r: h for b in prefix_trie.hashed(iter(made)) for r, h in zip(b.column("rep").to_pylist(), b.column("ends").to_pylist())}
    assert got == {r: hashlib.sha256(",".join(str(c) for q, c in rows if q == r).encode()).hexdigest() for r in (1, 2, 5)}


def test_twin(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    twin = con.sql(queries.TWINS["op13_prefix_trie"])
    assert twin.columns == prefix_trie.COLUMNS
    got = sorted(map(tuple, queries.QUERIES["op13_prefix_trie"](spark, folder).collect()), key=str)
    assert got == sorted(twin.fetchall(), key=str)
    rows = con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got == brute(rows)
