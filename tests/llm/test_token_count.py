import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from surveyscore.llm import token_count as tc

PATH = P.path("word_bpe_49k.json")
TRICKY = [
    None, "", " ", "\n\t", "The the THE.", "don't x's I'LL 'S ''s .'s", "12 3a4 ²½ µm", "a b\x85c\x1cd.\x1e!",
    "é É é", "ΣΑΣ οδος", "İstanbul ŞŞ", "漢字かな 한국어", "😀😀 a😀b", "<|startoftext|>", "x<|endoftext|>y <|ENDOFTEXT|>",
    "a" * 5000, "ab " * 3000, "x.y,z;;!! ...…", "  ​", "soft­hyphen", "ﬁ K ſ", "a\x00b",
]


def expected(text):
    return len(tc.load_tokenizer(tc.tokenizer_json(PATH)).encode(text or "", add_special_tokens=False).ids)


def counted(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int, text2 string")
    return tc.count_tokens(df, PATH, **kw)


def test_counts_equal_the_library(spark):
    rows = [(i, t, "clash", None, None) for i, t in enumerate(TRICKY)]
    got = {r.doc_id: r for r in counted(spark, rows, limit=4).collect()}
    for i, t in enumerate(TRICKY):
        assert got[i].n_tokens == expected(t), t
        assert got[i].n_bytes == len((t or "").encode())
        assert got[i].over_limit == (got[i].n_tokens > 4)


def test_every_latin1_character_splits_as_the_library_does():
    own = tc.load_tokenizer(tc.tokenizer_json(PATH))
    split = tc.Splitter(tc.tokenizer_json(PATH))
    for a in map(chr, range(256)):
        for text in (f"a{a}b", f"1{a}{a}.", f".{a}!", f"'{a}s", f"{a}'s {a}"):
            assert len(own.encode(text, add_special_tokens=False).ids) == sum(tc.lengths(own, split(text))), repr(text)


def test_random_texts():
    own, rnd = tc.load_tokenizer(tc.tokenizer_json(PATH)), random.Random(5)
    split = tc.Splitter(tc.tokenizer_json(PATH))
    letters = "aZé'st.,! \n\t1²ßΣ漢😀́​<|>"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        assert len(own.encode(text, add_special_tokens=False).ids) == sum(tc.lengths(own, split(text))), repr(text)


def test_repeated_rows_null_ids_and_small_tables(spark):
    rows = [(None, "one two", None, 1, "x"), (7, "one two", None, 1, "x"), (7, "one two", None, 1, "x")]
    got = sorted((r.doc_id is None, r.n_tokens) for r in counted(spark, rows, frequent=1).collect())
    assert got == [(False, 2), (False, 2), (True, 2)]
    assert counted(spark, []).count() == 0


def test_summaries_keep_the_heavy():
    from collections import Counter

    kept = tc.keep_heavy(Counter({"the": 50, "of": 20, **{f"w{i}": 1 for i in range(25)}}), 3)
    assert set(kept) >= {"the", "of"} and len(kept) <= 3


def test_other_tokenizers_split_at_blanks_only(spark):
    split = tc.Splitter('{"added_tokens": [], "pre_tokenizer": null, "normalizer": null}')
    assert split(" The end.\n") == ["The", "end."]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_on_the_whole_table(spark, sf):
    from surveyscore.llm.queries import QUERIES

    own = tc.load_tokenizer(tc.tokenizer_json(PATH))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    want = {r.doc_id: len(e.ids) for r, e in zip(docs, own.encode_batch([r.t for r in docs], add_special_tokens=False))}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, sf).collect()} == want
