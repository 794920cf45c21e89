"""One query per operator, with production parameters, over whole tables: ``(spark, sf_dir)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from surveyscore.llm import (
    byte_bpe, chat_format, decontaminate, embedding_dedup, fill_in_middle, maxent_lm, minhash_dedup, secrets,
    substring_dedup, surrogates, token_count, toxicity, vector_codes,
)
from surveyscore.llm.store import store

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_token_counts(spark, sf):
    return token_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_lm_score(spark, sf):
    return maxent_lm.score(table(spark, sf, "documents"), maxent_lm.held_out(F.col("doc_id")))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op3_byte_bpe(spark, sf):
    both = byte_bpe.encode(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN, offsets=False, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), "n_split")


@query
def op5_decontamination(spark, sf):
    found = decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def joined(spans: str):
    return F.array_join(F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"), ",")


@query
def op6_secret_scan(spark, sf):
    found = secrets.find_secrets(table(spark, sf, "documents"))
    count = lambda kind: F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(joined(f"filter(spans, s -> s.kind != '{secrets.ADDED}')"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))


@query
def op8_chat_format(spark, sf):
    control = spark.sql("""SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
                           FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    back = chat_format.read_windows(chat_format.format_windows(rows))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query
def op10_embedding_dedup(spark, sf):
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings"))


@query
def op4_minhash_dedup(spark, sf):
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"), percent=85)


@query
def op9_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    weights = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, weights).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))


@query
def op7_pii_surrogates(spark, sf):
    """The key would come from a secret store; a fixed one keeps the result the same from run to run."""
    found = surrogates.replace_entities(table(spark, sf, "documents"), b"documents-2024")
    count = lambda kind: F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long")
    return found.select("doc_id", F.size("spans").cast("long").alias("n_entities"),
                        *[count(k).alias(f"n_{k}") for k in surrogates.KINDS], "text", joined("spans").alias("spans"))


@query
def op13_fill_in_middle(spark, sf):
    made = fill_in_middle.rearrange(table(spark, sf, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op11_vector_codes(spark, sf):
    found, books = vector_codes.compress(table(spark, sf, "embeddings"), carried=("label",))
    coded = store(found, "codes")
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return coded.join(total, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.fingerprint(books)).alias("codebooks_sha256"))


@query
def op12_substring_dedup(spark, sf):
    found = substring_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
