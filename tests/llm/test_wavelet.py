import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegrid.llm import wavelet

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = open(PATH).read()
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None, "", " ", "Don't WE'LL they've ''s '\n's .'s it's2 'S", "été Été ́x ≮ ≯ a̸", "tab\t\x1c\x85 em", "<|endoftext|> a<|startoftext|>b <|x|>",
    "12ab3.4 ½ ١٢", "İstanbul ΣΑΣ ß", "中文字 🙂a🙂", "a" * 3000, "x.y,z!!  (q)", "'", "a'", "' s",
]


def brute(rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_equal_to_the_library(spark):
    rng = random.Random(4)
    signs = "aB'stre 1.\né́≮"
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "".join(rng.choice(signs) for _ in range(20))) for i in range(400)]
    rows += [(None, "b"), (None, None), (3, "a"), (3, "a")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    assert got(wavelet.digests(spark, docs, DEFINITION)) == brute(rows)
    assert wavelet.digests(spark, docs.limit(0), DEFINITION).count() == 0


def test_forgetting():
    data, bounds = wavelet.flat(__import__("pyarrow").array(TEXTS))
    encoder = wavelet._Encoder(DEFINITION, 3)
    for _ in range(3):
        ids, counts = encoder.encode(data, bounds)
        want = [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_other_definitions_are_refused():
    with pytest.raises(ValueError):
        wavelet._Encoder(DEFINITION.replace("Lowercase", "NFD"))


def test_queries_on_a_file(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 64)
    rng = np.random.default_rng(6)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.choice([0, 1, 5, 49407, 65535, 300, 301], n).astype(np.uint16)
        file = wavelet.WaveletFile(wavelet.build(ids, [1, None], [n, 0]))
        assert (file.tokens() == ids).all() and file.doc_ids == [1, None]
        for i in range(0, n, 7):
            assert file.access(i) == ids[i]
        for token in (0, 1, 5, 2, 49407, 65535):
            where = np.flatnonzero(ids == token)
            assert file.count(token) == len(where)
            assert file.count(token, n // 3, n // 2) == ((where >= n // 3) & (where < n // 2)).sum()
            assert [file.occurrence(token, k) for k in range(0, len(where), 5)] == where[::5].tolist()


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(wavelet.digests(spark, docs, DEFINITION)) == brute(rows)


def test_ids_go_from_a_shard_to_their_digest_in_one_worker(spark):
    # Two Python steps in one stage hold two workers a task beside those that encoded.
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = wavelet.digests(spark, docs, DEFINITION)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
