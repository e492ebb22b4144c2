import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidegrid.llm import weighted_sampling


def check(got, rows):
    """Against the definition: order, edited texts, and likeness as the share of equal samples."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in order]
    following = texts[1:] + texts[:1]
    changed = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following)]
    want = Counter((i, len(t), hashlib.sha256(c.encode()).hexdigest()) for (i, _), t, c in zip(order, texts, changed))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    signs = lambda texts: weighted_sampling.signatures(texts)
    own, other, after = signs(texts), signs(changed), signs(following)
    near = Counter((i, round(float((a == b).mean()), 6), round(float((a == c).mean()), 6)) for (i, _), a, b, c in zip(order, own, other, after))
    assert Counter((r.doc_id, round(r.near_edited, 6), round(r.near_next, 6)) for r in got) == near


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_order_and_edits(spark, parts):
    texts = [None, "", "a", "ab", "...", "Élan vital 中文 🙂🙂", "one two three four five six", "one two three four five six", "x " * 3000]
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.choice(texts)) for _ in range(90)] + [(None, "b"), (None, "a"), (None, None), (1 << 60, "big"), ((1 << 60) + 1, "bigger")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        check(weighted_sampling.fingerprints(docs).collect(), rows)
        few = rows[:1], [(None, "a"), (None, "b c")], [(5, "a b c"), (None, "d")], [(3, "x"), (2, "y")]
        for some in few:
            check(weighted_sampling.fingerprints(spark.createDataFrame(some, "doc_id long, text string")).collect(), some)
        assert weighted_sampling.fingerprints(docs.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    for _ in range(6):
        a = [rng.choice(words[:30]) for _ in range(300)]
        b = a[:200] + [rng.choice(words) for _ in range(100)]
        ca, cb = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
        true = sum((ca & cb).values()) / sum((ca | cb).values())
        x, y = weighted_sampling.signatures([" ".join(a), " ".join(b)], 4096)
        assert abs(float((x == y).mean()) - true) < 0.035


def test_long_texts_are_drawn_alike(monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(400)}" for _ in range(5000))
    whole = weighted_sampling.signatures([text, "a b c"])
    monkeypatch.setattr(weighted_sampling, "LONG", 10)
    assert (weighted_sampling.signatures([text, "a b c"]) == whole).all()
    assert not weighted_sampling.signatures(["", ""]).any()


def test_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = weighted_sampling.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, rows)
    long = [r for r in got if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.97
