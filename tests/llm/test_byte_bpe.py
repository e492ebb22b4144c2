import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegrid.llm import byte_bpe
from tidegrid.llm.arrays import flat

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TABLE = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=TABLE, special_tokens={})
TEXTS = [
    None, "", " ", "\n", "a", "  two  spaces \n\n next", "don't we'll they've I'm he'd 'stop ''s '\n's 're're x'lly",
    "tab\tand nbsp  em    x", "été ÉTÉ é ß 中文字 🙂🙂 a🙂b ½ ١٢٣ 12ab", "<|endoftext|> <|x|>",
    "end with spaces   ", "\x1c\x1d\x85​ a", "a" * 5000, "'s", "x 's y", "'", "a'é 'T 'S",
]


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def cut(texts):
    import pyarrow as pa

    data, bounds = flat(pa.array(texts, pa.string()))
    offsets, docs = byte_bpe.pretokens(data, bounds)
    words = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
    return [words[a:b] for a, b in zip(docs, docs[1:])]


def test_boundaries_follow_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert cut(TEXTS) == [pattern.findall(t or "") for t in TEXTS]
    rng = random.Random(1)
    signs = "a'strevlmd \n\t.9é 中!S"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(3000)]
    assert cut(texts) == [pattern.findall(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=6))
def test_boundaries_of_any_text(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert cut(texts) == [pattern.findall(t) for t in texts]


def test_equal_to_the_library(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 200)
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "x"), (3, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    got = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = [(i, *expected(t)) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {r.doc_id: expected(r.text) for r in docs.select("doc_id", "text").collect()}


def test_boundaries_do_not_depend_on_windows(monkeypatch):
    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(2)
    signs = "a'strevlmd \n\t.9é 中!S\u3000"
    texts = TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(500)]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(byte_bpe, "WINDOW_BYTES", size)
        assert cut(texts) == [pattern.findall(t or "") for t in texts]


def test_parts_of_a_block(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WINDOW_BYTES", 50)
    monkeypatch.setattr(byte_bpe, "PART_WORDS", 3)
    rows = list(enumerate(TEXTS * 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got)) == [(i, *expected(t)) for i, t in rows]
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in both} == {i: t or "" for i, t in rows}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in both} == {i: LIBRARY.encode_ordinary(t or "") for i, t in rows}


def test_cutting_a_block_takes_few_bytes_for_each_of_its_own():
    import pyarrow as pa

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(5000)]
    lines = [" ".join(rng.choices(words, k=20)) for _ in range(500)]
    # As many texts, and as one text.
    for texts in (["\n".join(rng.choices(lines, k=50)) for _ in range(1000)], ["\n".join(rng.choices(lines, k=50_000))]):
        data, bounds = flat(pa.array(texts, pa.string()))
        byte_bpe.pretokens(data[:10], np.array([0, 10]))
        tracemalloc.start()
        byte_bpe.pretokens(data, bounds)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 6 * len(data)


def test_ids_are_put_in_order_and_decoded_in_one_worker(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    plan = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    # Words, their ids, positions, and one for the rest.
    assert plan.count("MapInArrow") == 4
