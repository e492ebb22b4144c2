from collections import defaultdict

from tidegrid.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, line string, lost int"


def brute(rows, sites):
    seen, first = defaultdict(set), {}
    for i, text, source in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" ")
            if key and source is not None:
                seen[key].add(source)
            if key and i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text, source in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        kept, lines, have = [], text.split("\n"), set()
        for line in lines:
            key = line.strip(" ")
            if len(seen[key]) < sites or not key or (i is not None and first.get(key) == i and key not in have):
                kept.append(line)
            have.add(key)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(spark, rows, sites):
    docs = spark.createDataFrame([(i, t, "en", s, 1, "x", 2) for i, t, s in rows], SCHEMA)
    result = line_dedup.strip(docs, sites, counts=True)
    assert result.columns == [*docs.columns, "n_lines", "n_removed"]
    assert line_dedup.strip(docs, sites).columns == docs.columns
    return sorted(map(tuple, result.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


def test_hard_cases(spark):
    rows = [(i, f"own {i}\n  Menu \n\nMenu\nFooter é", f"s{i % 7}") for i in range(20)]
    rows += [(None, "Menu\nown", "s9"), (None, "Menu\nown", "s1"), (None, "only nameless", "a"), (None, "only nameless", "b"), (None, "only nameless", "c"),
             (30, None, "s1"), (31, "", "s1"), (32, "\n\n", None), (33, "Menu", None), (3, "Menu\nMenu", "s1"), (34, "l\n" * 5000 + "Menu", "s2")]
    for sites in (1, 3, 7, 8, 100):
        assert got(spark, rows, sites) == brute(rows, sites)


def test_counts_near_the_threshold_are_exact(spark):
    rows = [(n * 1000 + i, f"line {n}", f"s{i}") for n in range(40, 60) for i in range(n)]
    assert got(spark, rows, 50) == brute(rows, 50)


def test_empty_table(spark):
    assert got(spark, [], 3) == []


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = brute(rows, 10)
    result = line_dedup.strip(docs, 10, counts=True).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, result), key=str) == want
    assert sum(w[3] for w in want) > 100


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(i, f"menu\nown {i}", f"s{i}", 7, 8, "lost") for i in range(4)], "doc_id long, text string, source string, n_lines int, n_removed int, lost string")
    result = line_dedup.strip(docs, 3, counts=True)
    assert result.columns == ["doc_id", "text", "source", "lost", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed, r.lost) for r in result.collect()) == [(0, "menu\nown 0", 2, 0, "lost"), *((i, f"own {i}", 2, 1, "lost") for i in (1, 2, 3))]
    assert line_dedup.strip(docs, 3).columns == docs.columns


def test_many_shared_lines(spark):
    """The work grows with the lines of a document and not with their square."""
    import time

    text = "\n".join(f"line {k}" for k in range(20_000))
    docs = spark.createDataFrame([(i, text, "en", f"s{i}", 1, "x", 2) for i in range(12)], SCHEMA)
    started = time.time()
    lengths = {r.doc_id: len(r.text) for r in line_dedup.strip(docs, 10).collect()}
    assert lengths == {0: len(text), **{i: 0 for i in range(1, 12)}}
    assert time.time() - started < 30
