import itertools
import re

import numpy as np
import xxhash

from tidegrid.llm import simhash


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    values = np.array(prints, np.uint64)
    for x in range(len(rows)):
        for y in np.flatnonzero(np.bitwise_count(values[x + 1 :] ^ values[x]) <= 4) + x + 1:
            part[root(int(y))] = root(x)
    ids = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(x)] = min(i, ids.get(root(x), i))
    return sorted(((i, f"{p:016x}", ids.get(root(x))) for x, (i, p) in enumerate(zip([r[0] for r in rows], prints))), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_hard_cases(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "a b c d", "A  b\nc d", " nbsp\x1c", "É é", "x " * 600]
    texts += [" ".join(words), " ".join(words[:399] + ["zz"]), " ".join(words[:398]), " ".join(words[:200])]
    rows = [(i * 7 % 31, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "alone here"), (5, "one"), (5, "one")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    assert got(simhash.digests(docs)) == brute(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()]
    assert sorted(ids) == sorted({c for i, _, c in brute(rows) if i is not None and c is not None})


def test_empty_table(spark):
    assert simhash.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(simhash.digests(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_tiles_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SUBTILE", 16)
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = {int(s) for s in seeds}
    for s in seeds[:30]:
        for _ in range(20):
            s = s ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))
            values.add(int(s))
    values = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(df, 4, 100).collect()]
    groups = {int(v): {int(v)} for v in values.view(np.int64)}
    for a, b in edges:
        assert np.bitwise_count(np.uint64(a & (1 << 64) - 1) ^ np.uint64(b & (1 << 64) - 1)) <= 4
        merged = groups[a] | groups[b]
        for v in merged:
            groups[v] = merged
    for x, y in itertools.combinations(range(len(values)), 2):
        if np.bitwise_count(values[x] ^ values[y]) <= 4:
            assert int(values.view(np.int64)[y]) in groups[int(values.view(np.int64)[x])]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(20, 60)] + [(1, 2), (3, 2), (3, 9)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(20, 60)}, 2: 1, 3: 1, 9: 1}


def test_first_step_of_components_drops_no_repeats(spark, monkeypatch):
    # Dropping them shuffles all edges once more in every round, and there is one row per edge at most.
    seen, stage = [], simhash.stage

    def counted(df, name):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString().lstrip().split("\n")[0])
        return stage(df, name)

    monkeypatch.setattr(simhash, "stage", counted)
    edges = spark.createDataFrame([(x, x + 1) for x in range(1, 40)] + [(5, 5), (50, 60), (60, 50)], "a long, b long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {**{x: 1 for x in range(2, 41)}, 60: 50}
    assert [plan.startswith("Aggregate") for plan in seen] == [True] + [False, True] * (len(seen) // 2)
