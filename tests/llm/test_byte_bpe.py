import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from surveyscore.llm import byte_bpe as bb

PATH = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", " ", "Hello world", "  two  spaces \n\n x", "don't we'll", "漢字かな交じり", "😀👩‍👩‍👧 é é", "a" * 3000,
         "  \x1c", "x\r\n\ty ", "ñandú Straße 12345 ²½", "퟿�\U0010ffff", "word " * 2000]


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(bb.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, id int, decoded int")


def test_ids_equal_tiktoken_and_round_trip(spark, library):
    ids = bb.encode(frame(spark, [(i, t, "clash", 0, 0) for i, t in enumerate(TEXTS)]), PATH, P.PATTERN)
    got = {r.doc_id: r for r in ids.collect()}
    texts = {r.doc_id: bytes(r.decoded) for r in bb.decode(ids, PATH).collect()}
    rows = frame(spark, [(i, t, "clash", 0, 0) for i, t in enumerate(TEXTS)])
    assert {r.doc_id: bytes(r.decoded) for r in bb.encode(rows, PATH, P.PATTERN, decoded=True).collect()} == texts
    read = {r.doc_id: r.text for r in bb.decode_text(ids, PATH).collect()}
    for i, t in enumerate(TEXTS):
        assert list(got[i].ids) == library.encode_ordinary(t)
        assert texts[i] == t.encode() and read[i] == t
        assert [t[a:b].encode() for a, b in zip(got[i].starts, got[i].ends)] == want_pieces(t, got[i].ids, library)


def want_pieces(text, ids, library):
    """Characters that each token touches, by brute force over bytes."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    out, at = [], 0
    for token in library.decode_tokens_bytes(list(ids)):
        out.append(text[owner[at]:owner[at + len(token) - 1] + 1].encode())
        at += len(token)
    return out


def test_random_texts(library):
    encoder, rnd = bb.Encoder(bb.read_ranks(PATH), P.PATTERN), random.Random(3)
    letters = "aab  \n\té漢😀'st1.!ßx́​ _"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += [rnd.choice(letters) * rnd.randint(1, 400) for _ in range(300)]
    assert [list(i) for i in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_the_pattern_splits_every_character_as_tiktoken_does(library):
    encoder = bb.Encoder(bb.read_ranks(PATH), P.PATTERN)
    chars = [chr(c) for c in range(0, 0x11000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b{c} {c}1" for c in chars]
    assert [list(i) for i in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_split_characters_are_counted_and_named_whole(spark, library):
    text = next(t for t in ("𝔘𝔫𝔦", "🜁🜂", "𐍈𐍈") if len(library.encode_ordinary(t)) > len(t))
    row = bb.encode(frame(spark, [(1, text, None, None, None)]), PATH, P.PATTERN).first()
    assert row.n_split > 0 and set(zip(row.starts, row.ends)) <= {(a, b) for a in range(len(text)) for b in range(a + 1, len(text) + 1)}


def test_nulls_repeats_empty_table_and_bad_ids(spark):
    ids = bb.encode(frame(spark, [(None, None, None, None, None), (3, "x", None, None, None), (3, "x", None, None, None)]),
                    PATH, P.PATTERN, offsets=False)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in ids.collect()) == [(0, 0), (3, 1), (3, 1)]
    assert bb.encode(frame(spark, []), PATH, P.PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [220, None])], "doc_id long, ids array<int>")
    assert bytes(bb.decode(odd.where("doc_id = 1"), PATH).first().decoded) == b""
    with pytest.raises(Exception):
        bb.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), PATH).collect()


def test_query_on_the_whole_table(spark, library):
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
