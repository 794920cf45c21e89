"""From documents to training tokens: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyscore.llm import byte_bpe, decontaminate, minhash_dedup, secrets, toxicity
from surveyscore.llm.store import store

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def with_rows(docs: DataFrame) -> DataFrame:
    """A row's other columns as one column beside its text, so that operators carry them along."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside its held-out fold, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    found = toxicity.score(with_rows(docs), weights, "row", keep_text=True)
    return found.where("predicted = 0").select("row.*", "text").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one of least id, then of least text digest.

    A document is an id with its text: rows that share both count as one, of which the least by
    the other columns stays; rows that share an id only are told apart. Rows without an id all stay.
    """
    known = F.col("doc_id").isNotNull()
    key = F.when(known, F.struct("doc_id", F.when(known, F.xxhash64("text")).alias("text")))
    rows = docs.select(F.struct("*").alias("whole"), key.alias("key"), "text")
    found = minhash_dedup.near_duplicates(rows, id_col="key", percent=80)
    copies = store(found.where("not kept").select("key").distinct(), "copies")
    others = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]))
    named = docs.select(F.struct("*").alias("whole"), key.alias("key"), others.alias("others"))
    one = named.where("key is not null").join(copies, "key", "left_anti").groupBy("key").agg(
        F.min_by("whole", "others").alias("whole"))
    return one.select("whole.*").unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(with_rows(docs), benchmark, "row", keep_text=True, with_items=False)
    return found.where("n_hit = 0").select("row.*", "text").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts and n_chars, if there, counted anew."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of the bytes that they decode to."""
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    both = byte_bpe.encode(docs.select(F.struct(*kept).alias("key"), "text"), RANKS,
                           public_tokenizers.PATTERN, id_col="key", offsets=False, decoded=True)
    return both.select("key.*", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", to_tokens),
]
#: The stages' models and tokenizer are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
