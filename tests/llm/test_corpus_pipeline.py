import random

import corpus_pipeline
import test_byte_bpe
import test_decontaminate
import test_line_dedup
import test_simhash
from test_toxicity import text

from tidegrid.llm import line_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MENU = "home about contact terms"


def write(spark, folder, docs, labels, benchmark):
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def brute(spark, docs, labels, benchmark):
    """Ids and texts that each stage keeps, stage by stage, in plain Python behind the fitted classifier."""
    frame = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    scores = toxicity.predictions(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    rejected = {r.doc_id for r in scores if r.predicted}
    kept = [[row for row in docs if row[0] not in rejected]]
    source = {i: s for i, _, s in docs}
    kept.append([(i, t, source[i]) for i, t, *_ in test_line_dedup.brute(kept[-1], line_dedup.SITES)])
    first = {i for i, _, group in test_simhash.brute([(i, t) for i, t, _ in kept[-1]]) if i == group}
    kept.append([row for row in kept[-1] if row[0] in first])
    clean = {i for i, *_, hit in test_decontaminate.brute([(i, t) for i, t, _ in kept[-1]], benchmark) if not hit}
    kept.append([row for row in kept[-1] if row[0] in clean])
    return kept


def test_stages_and_rows_equal_brute_force(spark, tmp_path):
    rng = random.Random(11)
    sites = line_dedup.SITES + 2
    docs = [(i, text(rng, i % 5 == 0), f"s{i % sites}") for i in range(600)]
    bad = {i for i in range(600) if i % 5 == 0}
    docs = [(i, f"{MENU}\n{t}" if i % 3 else t, s) for i, t, s in docs]
    passage = text(rng, False, 40)
    docs += [(1000 + i, f"{text(rng, False)} {passage if i < 4 else ''} {text(rng, False)}", "s1") for i in range(8)]
    long = text(rng, False, 900).split(" ")
    docs += [(2000 + i, " ".join(long[: 100 * i] + [f"new{i}"] + long[100 * i :]), None) for i in range(6)]
    docs += [(3000 + i, docs[7][1], f"s{i}") for i in range(5)]
    docs += [(4000, None, "s1"), (4001, "", None), (4002, MENU, "s2"), (4003, "one two", "s3"), (4004, text(rng, False, 20_000), "s4")]
    labels = [(i, 1, int(i in bad)) for i in range(500)] + [(None, 0, 1), (7, 1, None)]
    benchmark = [(1, passage), (2, None), (3, ""), (4, text(rng, False, 30))]
    write(spark, tmp_path, docs, labels, benchmark)

    kept = brute(spark, docs, labels, benchmark)
    toxicity_kept = {row[0] for row in kept[0]}
    assert len(bad & toxicity_kept) <= 0.05 * len(bad)
    assert len({i for i, *_ in docs} - bad - toxicity_kept) <= 0.03 * len(docs)
    assert all(len(after) < len(before) for before, after in zip(kept[1:], kept[2:]))
    assert any(a[1] != b[1] for a, b in zip(sorted(kept[0], key=str), sorted(kept[1], key=str)))

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = before.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, kept):
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        assert before.columns == columns
        got = before.collect()
        assert sorted(((r.doc_id, r.text, r.source) for r in got), key=str) == sorted(want, key=str), name
        if name == "line_dedup":
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)

    final = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, final)) == sorted((i, *test_byte_bpe.expected(t)) for i, t, _ in kept[-1])


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
