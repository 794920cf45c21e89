import hashlib

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from surveyscore.llm import byte_bpe, decontaminate, secrets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        docs = cp.store(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns_and_only_drop_rows(spark, staged):
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for df in staged[:3]:
        rows = df.collect()
        assert df.columns == COLUMNS and all(before[r.doc_id] == r for r in rows)
        before = {r.doc_id: r for r in rows}
    assert staged[3].columns == COLUMNS and staged[3].count() == staged[4].count() == len(before)


def test_near_duplicates_leave_one_of_each_group(spark, staged):
    from test_near_duplicates import brute_texts

    rows = [(r.doc_id, r.text) for r in staged[0].collect()]
    kept = {i for i, _, least, _ in brute_texts(rows, 80) if i == least}
    assert {r.doc_id for r in staged[1].collect()} == kept


def test_decontamination_drops_exactly_the_hit_documents(spark, staged):
    from test_decontaminate import brute

    rows = [(r.doc_id, r.text) for r in staged[1].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in staged[2].collect()} == {i for i, _, hit, _ in brute(rows, items) if not hit}


def test_secrets_are_masked_and_other_text_stays(staged):
    before = {r.doc_id: r.text for r in staged[2].collect()}
    for r in staged[3].collect():
        text, at = "", 0
        for a, b in secrets.merged([(a, b) for _, a, b in secrets.find_spans(before[r.doc_id])]):
            text, at = text + before[r.doc_id][at:a] + "<secret>", b
        assert r.text == text + before[r.doc_id][at:] and r.n_chars == len(r.text)


def test_tokens_are_those_of_the_library(staged):
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(cp.RANKS))}
    library = tiktoken.Encoding("own", pat_str=cp.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in staged[3].collect()}
    for r in staged[4].collect():
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, staged):
    assert cp.run(spark, SF).agg(F.sum("n_tokens"), F.count("*")).first() == staged[4].agg(F.sum("n_tokens"), F.count("*")).first()


def test_edge_rows_pass_through(spark):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id", None, "s", 5), (None, "no id", None, "s", 5), (3, "same text here", "en", "s", 14),
           (4, "same text here", "de", "s", 14), (3, "same text here", "en", "s", 14), (5, "word " * 30000, "en", "s", 1)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[:-1]:
        docs = cp.store(stage(spark, docs, SF), name)
    kept = sorted((r.doc_id or -1, None if r.text is None else len(r.text)) for r in docs.collect())
    assert kept == [(-1, 5), (-1, 5), (1, None), (2, 0), (3, 14), (5, 150000)]
    assert cp.to_tokens(spark, docs, SF).count() == 6


def test_one_id_with_two_texts_keeps_both(spark):
    odd = [(5, "first text of its own with some words"), (5, "second and quite another text it is"), (6, "a third one"),
           (7, "second and quite another text it is"), (4, "a third one"), (8, "first text of its own with some words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text[:5]) for r in kept) == [(4, "a thi"), (5, "first"), (5, "secon")]


def test_extra_and_missing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "some words to keep here", {"a": 1}, "x", 2), (2, "some words to keep here", {"b": 2}, "y", 3), (2, "some words to keep here", {"a": 2}, "y", 3)],
        "doc_id long, text string, key map<string,int>, row string, predicted int")
    for name, stage in cp.STAGES[:-1]:
        docs = cp.store(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "key", "row", "predicted"]
    assert [tuple(r)[:3] for r in docs.collect()] == [(1, "some words to keep here", {"a": 1})]
    assert cp.to_tokens(spark, docs, SF).count() == 1


def test_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = cp.store(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_windows_of_the_benchmark_are_bounded_per_scan():
    assert decontaminate.MAX_WINDOWS <= 40_000
