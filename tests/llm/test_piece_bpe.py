import hashlib
import random

import public_tokenizers
import sentencepiece

from tidegrid.llm import known, piece_bpe

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
TEXTS = [
    None, "", " ", "  ", "a", " a", "  a b ", "▁x", "a▁b ▁ c", "\xa0q", "é ñ\xa0 x", "é", "tab\t\tx\n\ny \n", "<s>x</s><0x41><unk>",
    "a\x00b", "﻿q", "中文字 🙂a🙂 ﬁ", "İstanbul ΣΑΣ ß  x　 y", "a" * 3000, " " * 100, "\n" * 50, "x.y,z!!  (q)", "don't ''s 12ab3.4 ½ ١٢", "\U0010ffff ",
]


def expected(text):
    ids = LIBRARY.encode(text or "")
    listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return len(ids), listed, hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_equal_to_the_library(spark):
    rng = random.Random(3)
    signs = ["a", "b", "s", "t", "re", "ing", "the", " ", " ", "\n", "é", "▁", ".", "中", "🙂", "1", "tion", "ed", "́"]
    rows = list(enumerate(TEXTS)) + [(100 + i, "".join(rng.choice(signs) for _ in range(30))) for i in range(1500)]
    rows += [(None, "b"), (None, None), (3, "a"), (3, "a")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    got = piece_bpe.digests(docs, MODEL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, *expected(t)) for i, t in rows), key=str)
    assert piece_bpe.digests(docs.limit(0), MODEL).count() == 0


def test_words_without_cuts_and_backtracking():
    """Whole random texts of signs that merge in many ways, without the cut at blanks."""
    pieces, rng = piece_bpe._pieces(MODEL), random.Random(5)
    parts = [t for i in rng.sample(pieces.usable, 3000) if (t := pieces.texts[i])]
    for _ in range(1500):
        text = "".join(p[: rng.randint(1, len(p))] for p in rng.choices(parts, k=12)).replace(piece_bpe.BLANK, " ")
        assert pieces.encode((" " + text).replace(" ", piece_bpe.BLANK)) == LIBRARY.encode(text), text


def test_given_up_pieces_and_ties():
    """A small vocabulary in which the longest piece is wrong, one piece is never reached, and one sign is part of a piece only."""
    texts = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), "a", "b", "c", "ab", "bc", "abc", "cc", "bcc", "xa", "acb"]
    kinds = [piece_bpe.UNKNOWN, *[piece_bpe.BYTE] * 256, *[piece_bpe.NORMAL] * 10]
    scores = [0.0] * 257 + [-9, -9, -9, -1, 0, -2, -1, -1, -3, 5]
    pieces = piece_bpe.Pieces(texts, scores, kinds)
    named = {texts[i] for i in pieces.usable}
    assert "acb" not in named and {"abc", "bcc"} <= named
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("abcx") for _ in range(rng.randint(0, 14)))
        want = [i for s in pieces.merge(list(text)) for i in ([pieces.ids[s]] if s in pieces.ids else [pieces.bytes[b] for b in s.encode()])]
        assert pieces.encode(text) == want, text


def test_words_together():
    """Many words at once give what each gives alone: backtracking, signs that are no piece, the sign between words, long and empty ones."""
    rng = random.Random(9)
    texts = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), "a", "b", "c", "ab", "bc", "abc", "cc", "bcc", "xa", "acb"]
    kinds = [piece_bpe.UNKNOWN, *[piece_bpe.BYTE] * 256, *[piece_bpe.NORMAL] * 10]
    small = piece_bpe.Pieces(texts, [0.0] * 257 + [-9, -9, -9, -1, 0, -2, -1, -1, -3, 5], kinds)
    large = piece_bpe._pieces(MODEL)
    parts = [t for i in rng.sample(large.usable, 2000) if (t := large.texts[i])]
    cut = ["".join(p[: rng.randint(1, len(p))] for p in rng.choices(parts, k=6)).replace(piece_bpe.BLANK, " ") for _ in range(3000)]
    odd = ["", "a\x00b", "\x00", "中文", "a" * 3000, " " + "the" * 100, "é🙂", small.gap, large.gap + "a"]
    for pieces, words in ((small, ["".join(rng.choice("abcx") for _ in range(rng.randint(0, 14))) for _ in range(3000)]), (large, cut)):
        words = words + odd
        rng.shuffle(words)
        got = [list(memoryview(ids).cast("I")) for ids in pieces.words([w.encode() for w in words])]
        assert got == [pieces.encode(w.replace(" ", piece_bpe.BLANK)) for w in words]
        assert pieces.words([w.encode() for w in words[:7]]) == pieces.words([w.encode() for w in words])[:7]
    left = large.together([w.replace(" ", piece_bpe.BLANK) for w in cut]).count(None)
    assert left < piece_bpe.FEW
    assert large.words([]) == []


def test_one_worker_per_task(spark):
    """Ids and texts do not go through a chain of Python workers, and the operators one by one give the same."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = piece_bpe.digests(docs, MODEL)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    steps = {r.doc_id: r for r in piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL).collect()}
    for r in got.collect():
        ids = memoryview(bytes(steps[r.doc_id].ids)).cast("I")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(steps[r.doc_id].decoded.encode()).hexdigest()


def test_decoding_ids_of_any_origin(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice([rng.randrange(32000), rng.randrange(0, 259), 29871]) for _ in range(rng.randint(0, 12))]) for i in range(600)]
    packed = [(i, b"".join(t.to_bytes(4, "little") for t in ids)) for i, ids in rows]
    got = piece_bpe.decode(spark.createDataFrame(packed, "doc_id long, ids binary"), MODEL).collect()
    assert {r.doc_id: r.decoded for r in got} == {i: LIBRARY.decode(ids) for i, ids in rows}


def test_forgetting():
    import numpy as np

    pieces = piece_bpe._pieces(MODEL)
    small = known.Known(pieces.words, pieces=3)
    for text in ("one two three four five", "six one seven two", "one"):
        data, bounds = known.with_space(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        ids, _ = small.numbers(data, known.cuts(data, bounds))
        assert ids.tolist() == LIBRARY.encode(text)


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(MODEL)
    model.normalizer_spec.remove_extra_whitespaces = True
    try:
        piece_bpe.read_model(model.SerializeToString())
    except ValueError:
        return
    raise AssertionError("accepted")


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r.doc_id, *expected(r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, piece_bpe.digests(docs, MODEL).collect())) == want
