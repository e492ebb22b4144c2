import random
import zlib

import numpy as np

from tidegrid.llm import toxicity

HATE = ["vermoxin", "drastgul", "pilkforn"]


def text(rng, bad, words=60):
    syllables = ["an", "ther", "ing", "on", "ed", "the", "re", "sh", "ou", "ti"]
    out = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(words)]
    for _ in range(3 if bad else 0):
        out.insert(rng.randrange(len(out)), rng.choice(HATE))
    return " ".join(out)


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[label].mean() - (label.sum() - 1) / 2) / max((~label).sum(), 1)


def test_learns_and_leaves_clean_texts_alone(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, i % 5 == 0, 10 + i % 300), i % 5 == 0) for i in range(1500)]
    extra = [(None, text(rng, True)), (2000, None), (2001, ""), (2002, "... 123"), (2003, "pilkforn"), (3, rows[3][1]), (2004, text(rng, False, 60_000))]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(i, t, "x") for i, t in extra], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in rows] + [(None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity.predictions(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    held = {r.doc_id: r for r in got if r.held_out}
    assert set(held) == {i for i in [*range(1500), *range(2000, 2005)] if zlib.crc32(str(i).encode()) % 5 == 0}
    truth = {i: bad for i, _, bad in rows}
    known = [r for r in held.values() if r.doc_id in truth]
    label = np.array([truth[r.doc_id] for r in known])
    assert auc(np.array([r.score for r in known]), label) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    wrong = sum(r.predicted != truth[r.doc_id] for r in known)
    assert wrong <= 0.03 * len(known)
    by_id = {r.doc_id: r.predicted for r in got}
    assert by_id[None] == 1 and by_id[2000] == by_id[2001] == by_id[2002] == by_id[2004] == 0
    kept = toxicity.remove(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if not r.predicted)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.predictions(docs, none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.remove(docs, toxicity.train(docs, one)).count() == 2
    assert toxicity.predictions(docs.limit(0), one).count() == 0


def test_few_texts():
    model = toxicity.fit(["you vermoxin"], ["good day"])
    assert np.isfinite(model.score(toxicity._words(["a vermoxin", "", None]))).all()


def test_held_out_rows_of_the_tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    docs, labels = read("documents"), read("labels")
    rows = toxicity.predictions(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    label = np.array([r.toxic == 1 for r in rows])
    assert auc(np.array([r.score for r in rows]), label) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.8
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.03
