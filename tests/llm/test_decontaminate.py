import hashlib
import random
import re

from tidegrid.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for at in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[at : at + n]), set()).add(item)
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        found.discard(None)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


LONG = " ".join(f"w{i}" for i in range(25))
ITEMS = [(1, LONG), (2, "Short Été item"), (10, "w3 w4"), (3, None), (4, ""), (5, "..."), (None, "no id"), (2, "Short Été item"), (6, "x x x")]
DOCS = [
    (1, None), (2, ""), (3, "a SHORT Été-item!"), (4, "é" + LONG), (5, LONG + " " + LONG), (6, "w3, w4 w3 w4"), (7, " ".join(LONG.split()[5:14])),
    (8, " ".join(LONG.split()[5:15])), (9, "No id"), (None, "w3 w4"), (1, "short"), (11, "x x x x x y x x"), (12, "z " * 20000 + LONG),
    (13, "short été"), (14, "item"),
]


def test_equal_to_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in DOCS], "doc_id long, text string, items int").repartition(2)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(DOCS, ITEMS)
    assert got(decontaminate.digests(docs, bench)) == want
    split = decontaminate.scan(docs, bench, part_bytes=40).selectExpr("doc_id", "items", "aggregate(spans, 0L, (a, s) -> a + s.end - s.start) AS n").collect()
    assert sorted(((r.doc_id, r.n, len(r["items"])) for r in split), key=str) == sorted(((w[0], w[2], w[3]) for w in want), key=str)


def test_removal(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in DOCS], "doc_id long, text string, items int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = [w[0] for w in brute(DOCS, ITEMS) if not w[5]]
    for size in (40, 1 << 20):
        left = decontaminate.remove(docs, bench, part_bytes=size)
        assert left.columns == docs.columns
        assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(clean, key=str)
    cut = decontaminate.remove(docs, bench, what="spans")
    assert {r.text for r in cut.where("doc_id = 3").collect()} == {"a !"}
    assert cut.where("text IS NULL").count() == 1
    assert not any(w[5] for w in brute([(r.doc_id, r.text) for r in cut.where("doc_id <> 6").collect()], ITEMS))


def test_spans_of_parts_are_found_before_any_is_cut(spark):
    """Two overlapping items in different parts: cutting one must not hide the other."""
    left, right = LONG, " ".join(f"w{i}" for i in range(16, 40))
    docs = spark.createDataFrame([(1, f"a {left} {' '.join(right.split()[9:])} b", [1], "x")], "doc_id long, text string, spans array<int>, row string")
    bench = spark.createDataFrame([(1, left), (2, right)], "item_id long, text string")
    for size in (20, 1 << 20):
        cut = decontaminate.remove(docs, bench, what="spans", part_bytes=size)
        assert cut.columns == docs.columns
        (row,) = cut.collect()
        assert row.text.split() == ["a", "b"] and row.spans == [1] and row.row == "x"


def test_index_is_bounded_by_its_text():
    rng = random.Random(3)
    shared = " ".join(rng.choice("abcdefghij") for _ in range(500))
    texts = {
        "short words": [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2000)) for _ in range(200)],
        "other words": [" ".join(f"{rng.randrange(1 << 20):x}" for _ in range(1000)) for _ in range(200)],
        "one passage in all": [f"{shared} {k}" for k in range(500)],
        "one word": ["x " * 100_000],
    }
    for name, items in texts.items():
        index = decontaminate.Index(list(enumerate(items)), 10)
        assert index.nbytes <= decontaminate.INDEX_RATIO * sum(map(len, items)), name


def test_several_parts_of_many_items(spark):
    """Items share passages, and each part is scanned after the rows of the part before were stored."""
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    shared = " ".join(rng.choices(vocabulary, k=30))
    items = [(k, f"{shared if k % 3 == 0 else ''} {' '.join(rng.choices(vocabulary, k=rng.randrange(1, 60)))}") for k in range(300)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=50)) + " " + rng.choice(items)[1] + " tail") for k in range(120)] + [(None, shared), (3, shared), (3, shared)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, items)
    assert got(decontaminate.digests(rows, bench)) == want
    parts = decontaminate.scan(rows, bench, part_bytes=sum(len(t) for _, t in items) // 3)
    found = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"])) for r in parts.collect()]
    assert sorted(found, key=str) == sorted((w[:4] for w in want), key=str)


def test_hashes_that_collide(monkeypatch):
    """Windows are told apart by their words even where all hashes are equal."""
    monkeypatch.setattr(decontaminate, "_hash", lambda codes, starts, length: starts.astype("uint64") * 0)
    items = [(1, "a b c a b"), (2, "b c a b"), (3, "c c c c c"), (4, "a b")]
    index = decontaminate.Index(items, 3)
    docs = ["x a b c", "b c a", "c c c c", "a b", "b c c"]
    data, bounds = decontaminate.flat(decontaminate.pa.array(docs))
    words = decontaminate.Words(data, bounds, decontaminate.IS_WORD)
    hit, found = index.scan(words)
    assert found == [[1, 4], [1, 2], [3], [4], []]
    assert hit.tolist() == [False] + [True] * 3 + [True] * 3 + [True] * 4 + [True] * 2 + [False] * 3


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(decontaminate.digests(docs, none)) == brute(DOCS, [])
    assert decontaminate.remove(docs, none).count() == len(DOCS)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.digests(docs.limit(0), bench).count() == 0


def test_tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    docs, bench = read("documents"), read("benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert got(decontaminate.digests(docs, bench)) == want
    assert any(w[5] for w in want)
