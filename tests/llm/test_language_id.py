import zlib

import numpy as np

from tidegrid.llm import language_id


def test_gradients_are_those_of_the_loss():
    network = language_id.Network(["a", "b", "c"])
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(1)
    windows, labels = rng.integers(0, 256, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, slopes = network.gradients(windows, labels)
    for name, weight in network.weights.items():
        for at in list(np.ndindex(weight.shape))[:: max(weight.size // 7, 1)]:
            if name[:2] == "in":
                at = (int(windows[0, 3]), at[1])
            old, step = weight[at], 1e-2
            weight[at] = old + step
            up = network.gradients(windows, labels)[0]
            weight[at] = old - step
            down = network.gradients(windows, labels)[0]
            weight[at] = old
            assert abs((up - down) / (2 * step) - slopes[name][at]) < 2e-4


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = language_id.predictions(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_hard_cases(spark):
    rows = [(i, "the and of with that " * (1 + i % 9), "en", "x") for i in range(40)] + [(50 + i, "der die und nicht sich " * (1 + i % 9), "de", "x") for i in range(40)]
    rows += [(200, None, "en", "x"), (201, "", "de", "x"), (202, "123 !?", "en", "x"), (None, "und der nicht", None, "x"), (203, "é", None, "x"), (1, rows[1][1], "en", "x"), (204, "of the " * 30_000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language_id.predictions(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[200] == by_id[201] == by_id[202] == ("und", 0.0)
    assert by_id[None][0] == "de" and by_id[204][0] == "en" and by_id[203][0] in ("de", "en")
    unknown = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in language_id.predictions(unknown).collect()} == {"und"}
    assert language_id.predictions(docs.limit(0)).count() == 0
