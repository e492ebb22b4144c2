import corpus_pipeline

from tidegrid.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def line(name, words):
    return " ".join(f"{name}{i}" for i in range(words))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


def test_long_lines_of_few_sites_stay_once(spark):
    p, q, short, nameless = line("p", 51), line("q", 60), line("s", 50), line("n", 70)
    rows = [(3, f"a\n{p}\nb\n{p}", "hot"), (4, f" {p} \nc\n{short}", "hot"), (5, f"{short}\n{p}", None), (6, q, None), (9, f"x\n{q}", None)]
    rows += [(None, f"{nameless}\none", "s"), (None, f"two\n{nameless}", "s"), (None, f"{q}\nthree", "s"), (7, None, "s"), (8, "", "s"), (2, f"{line('own', 80)}\n" * 2, "s")]
    rows += [(10, f"f\n{line('r', 55)}", "s"), (10, f"g\n{line('r', 55)}", "s")]
    got = sorted(((r.doc_id, r.text) for r in line_dedup.strip_passages(frame(spark, rows)).collect()), key=str)
    texts = [t for _, t in got if t is not None]
    assert len(got) == len(rows)
    assert (3, f"a\n{p}\nb") in got and (4, f"c\n{short}") in got and (5, short) in got
    assert (6, q) in got and (9, "x") in got and (None, "three") in got
    assert (7, None) in got and (8, "") in got and (2, f"{line('own', 80)}\n" * 2) in got
    assert sum(nameless in t for t in texts) == sum(line("r", 55) in t for t in texts) == 1
    assert line_dedup.strip_passages(frame(spark, [])).count() == 0


def test_pipeline_stage_removes_passages_on_fewer_than_ten_sites(spark):
    passage = line("p", 60)
    docs = frame(spark, [(i, f"{line(f'a{i}x', 90)}\n{passage}\n{line(f'b{i}x', 90)}", f"s{i % 3}") for i in range(8)])
    out = corpus_pipeline.boilerplate_lines(spark, docs, "")
    assert out.where(f"contains(text, '{passage}')").count() == 8
    got = corpus_pipeline.near_duplicates(spark, out, "")
    assert got.columns == docs.columns and got.count() == 8
    assert [r.doc_id for r in got.collect() if passage in r.text] == [0]
    assert all(r.n_chars == len(r.text) for r in got.collect())
