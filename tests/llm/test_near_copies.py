import random
import re

from tidegrid.llm import near_copies

SCHEMA = "doc_id long, text string, source string"


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w]
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(rows):
    sets, part = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]):
                part[root(x)] = root(y)
    groups = {}
    for x, row in enumerate(rows):
        groups.setdefault(root(x), []).append(row)
    return list(groups.values())


def check(spark, rows, tile=near_copies.TILE, inline=near_copies.INLINE_BYTES):
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], SCHEMA)
    kept = near_copies.keep_one(docs, tile=tile, inline=inline)
    assert kept.columns == docs.columns
    got, groups = [(r.doc_id, r.text) for r in kept.collect()], brute(rows)
    assert len(got) == len(groups)
    for group in groups:
        # One row of each group, with the smallest id that it has.
        own = [row for row in got if row in group]
        assert len(own) == 1
        assert own[0][0] == min((i for i, _ in group if i is not None), default=None)
    return got


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_edited_copies_on_both_sides_of_the_threshold(spark):
    rng = random.Random(2)
    rows = []
    for n in (30, 100, 400, 2000):
        for _ in range(6):
            base = words(rng, n)
            rows += [(len(rows) + k, edited(rng, base, round(n * share))) for k, share in enumerate((0, 0.01, 0.015, 0.02, 0.022, 0.025, 0.03))]
    got = check(spark, rows)
    assert len(got) < 0.9 * len(rows)


def test_shared_passages_in_tiles(spark):
    rng = random.Random(3)
    passage, rows = words(rng, 60), []
    for i in range(60):
        base = words(rng, 40)
        rows += [(1000 - 3 * i - k, " ".join(passage) + " " + edited(rng, base, k)) for k in range(3)]
    rows += [(2000 + i, edited(rng, passage, 1)) for i in range(40)]
    for inline in (near_copies.INLINE_BYTES, 10_000, 0):
        # All tiles in rows, some of them in files, all of them in files.
        check(spark, rows, tile=16, inline=inline)


def test_defined_cases(spark):
    base = " ".join(words(random.Random(4), 50))
    rows = [(3, None), (4, ""), (None, " \n"), (5, "one"), (None, "ONE"), (6, "one two"), (None, "alone"), (None, "alone"), (None, "alone  "), (7, base), (7, base), (7, "other text of it"), (8, "Other text of it")]
    check(spark, rows)
    assert near_copies.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_removes_copies_that_differ_by_more_than_four_bits(spark):
    import corpus_pipeline
    from tidegrid.llm import simhash

    rng = random.Random(5)
    base = words(rng, 200)
    rows = [(i, edited(rng, base, 3 * (i > 0)), "s") for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(length(text) AS long) AS n_chars")
    groups = brute([row[:2] for row in rows])
    assert simhash.keep_one(docs).count() > len(groups)
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == len(groups)


def test_stage_goes_by_fingerprints_first(spark, monkeypatch):
    import corpus_pipeline
    from tidegrid.llm import simhash

    rng = random.Random(6)
    rows = []
    for n in (8, 60, 300):
        for _ in range(5):
            base = words(rng, n)
            rows += [(len(rows) + k, edited(rng, base, k), "s") for k in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(length(text) AS long) AS n_chars")
    pairs, apart = [], []

    def prints(*args):
        pairs.append(near(*args))
        return pairs[-1]

    def stars(members, groups):
        apart.append((real_stars(members, groups).count(), members.where("node != least").select("node", "least").distinct().count()))
        return real_stars(members, groups)

    near, real_stars = near_copies.fingerprint_pairs, near_copies.star_pairs
    monkeypatch.setattr(near_copies, "fingerprint_pairs", prints)
    monkeypatch.setattr(near_copies, "star_pairs", stars)
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == len(brute([row[:2] for row in rows]))

    # The candidates' closure is that of all fingerprints within the radius.
    nodes = {r.key_id: (r.node, r.fp & (1 << 64) - 1) for r in near_copies.nodes(docs, 5).collect()}
    made = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.fingerprints(docs, 5).collect()}
    assert {i: fp for i, (_, fp) in nodes.items()} == made
    within = [(x, y) for x, p in nodes.values() for y, q in nodes.values() if x < y and (p ^ q).bit_count() <= near_copies.RADIUS]
    got = [tuple(r) for r in pairs[0].collect()]
    assert {(min(p), max(p)) for p in got} <= set(within)

    def reached(edges):
        part = {x: x for x, _ in nodes.values()}
        for _ in nodes:
            for x, y in edges:
                part[x] = part[y] = min(part[x], part[y])
        return part

    assert within and reached(got) == reached(within)
    # Prefixes are left with what the fingerprints did not link.
    assert apart[0][0] < apart[0][1]


def test_a_task_hands_on_each_node_once():
    rng = random.Random(8)
    pairs = [[(rng.randrange(300), rng.randrange(300)) for _ in range(40)] for _ in range(30)]
    for limit in (10**6, 50):
        out = [edge for batch in near_copies.forests(iter(pairs), limit) for edge in zip(*(c.to_pylist() for c in batch.columns))]
        ends = set().union(*(set(p) for part in pairs for p in part))
        for edges in (out, [p for part in pairs for p in part]):
            label = {x: x for x in ends}
            while any(label[x] != label[y] for x, y in edges):
                for x, y in edges:
                    label[x] = label[y] = min(label[x], label[y])
            want = label if edges is out else want
        assert label == want
        assert all(x > y for x, y in out)
        assert limit == 50 or len({x for x, _ in out}) == len(out) < len(ends)
    assert list(near_copies.forests(iter([[], []]))) == []
