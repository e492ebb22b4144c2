import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidegrid.llm import alignment

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json")).read()
MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
FIRST = Tokenizer.from_str(DEFINITION)
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
SIGNS = alignment._byte_signs()
TEXTS = [
    None, "", " ", "  ", "a", " a", "  a  b \n c ", "a▁b", "▁", "<|endoftext|> <s> x", "don't WE'LL 's", "é ñ\xa0 x　 y", "中文字 🙂a🙂", "a" * 2000,
    "tab\t\tx\n\ny \n", "a\x00b", "12ab3.4 ½", "[SENT] x.y,z!!  (q)", "word word word",
]


def tokens(text):
    """Ids and byte ends of both tokenizers over whole texts, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = FIRST.encode(" " + text, add_special_tokens=False).ids
    b = SECOND.encode(text)
    of_a = [bytes(SIGNS[c] for c in FIRST.id_to_token(i)) for i in a]
    of_b = [bytes([int(p[3:5], 16)]) if SECOND.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [SECOND.id_to_piece(i)]]
    if b"".join(of_a) != raw or b"".join(of_b) != raw:
        return None

    def ends(parts):
        out, at = [], 0
        for part in parts:
            at += len(part)
            out.append(at)
        return out

    return a, b, ends(of_a), ends(of_b)


def brute(rows):
    found = [(i, tokens(t)) for i, t in rows]
    links, groups = {}, {}
    for k, (_, known) in enumerate(found):
        links[k], groups[k] = [], []
        if known:
            a, b, a_ends, b_ends = known
            ending = dict(zip(b_ends, b))
            links[k] = [(x, ending[end]) for x, end in zip(a, a_ends) if end in ending]
            sides, of_b = [[], []], iter(zip(b, b_ends))
            for x, end in zip(a, a_ends):
                sides[0].append(str(x))
                if end in ending:
                    for y, other in of_b:
                        sides[1].append(str(y))
                        if other == end:
                            break
                    groups[k].append("|".join(map(",".join, sides)))
                    sides = [[], []]
    counts = Counter(link for some in links.values() for link in some)
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    out = []
    for k, (i, known) in enumerate(found):
        sha = hashlib.sha256(";".join(groups[k]).encode()).hexdigest() if known else ""
        n_a, n_b = (len(known[0]), len(known[1])) if known else (0, 0)
        best = sum(counts[link] == highest[link[1]] for link in links[k])
        out.append((i, n_a, n_b, len(groups[k]), len(links[k]), best, sum(counts[link] for link in links[k]), sha))
    return out


def check(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_a string").repartition(parts)
    got = alignment.digests(docs, DEFINITION, MODEL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_equal_to_brute_force(spark):
    rng = random.Random(9)
    signs = ["a", "st", "re", "ing", "the", " ", " ", "\n", "é", "▁", ".", "中", "🙂", "1", "tion", "'s"]
    rows = list(enumerate(TEXTS)) + [(100 + i, "".join(rng.choice(signs[: 9 if i % 2 else 16]) for _ in range(25))) for i in range(400)]
    rows += [(None, "b"), (None, None), (3, "a"), (3, "a")]
    check(spark, rows)


def test_nothing_to_count(spark):
    check(spark, [(1, None), (2, ""), (3, "▁")], 1)
    assert alignment.digests(spark.createDataFrame([], "doc_id long, text string"), DEFINITION, MODEL).count() == 0


def test_galloping_intersection():
    rng = random.Random(2)
    for _ in range(2000):
        left, right = (sorted(rng.sample(range(60), rng.randint(0, n))) for n in (rng.choice((3, 60)), rng.choice((3, 60))))
        common = sorted(set(left) & set(right))
        want = ([left.index(v) for v in common], [right.index(v) for v in common])
        assert alignment.common_ends(left, right) == want


def test_groups_of_texts(spark):
    rows = [(1, "unbelievable   things"), (2, None), (3, "▁")]
    blocks = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), DEFINITION, MODEL)
    got = {r.doc_id: r for r in alignment.groups(blocks).collect()}
    a, b, a_ends, b_ends = tokens(rows[0][1])
    common = sorted(set(a_ends) & set(b_ends))
    assert (got[1].a_ids, got[1].b_ids) == (a, b)
    assert got[1].a_ends == [a_ends.index(e) + 1 for e in common] and got[1].b_ends == [b_ends.index(e) + 1 for e in common]
    assert got[2].a_ids == got[3].b_ids == []


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.digests(docs, DEFINITION, MODEL).collect())) == sorted(brute(rows))
