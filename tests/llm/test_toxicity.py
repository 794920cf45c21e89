import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyscore.llm import mixing
from surveyscore.llm import toxicity as tx


def test_gradient_against_finite_differences():
    texts, labels = ["good day. bad word here! fine", "calm words. more", ""], np.array([1, 0, 0])
    rng = np.random.default_rng(1)
    start = {"words": rng.standard_normal(tx.BUCKETS) * 0.5, "base": np.array([-1.0])}

    def loss(w):
        total = 0.0
        for t, y in zip(texts, labels):
            z = np.array([w["base"][0] + sum(w["words"][f] for x in s for f in tx.features(x)) for _, _, s in tx.sentences(t)] or [w["base"][0]])
            p = tx.noisy_or(z)
            total -= np.log(p if y else 1 - p)
        return total

    own = {k: v.copy() for k, v in start.items()}
    squares = {k: np.full(len(v), 1e-300) for k, v in own.items()}
    counts = {k: np.zeros(len(v)) for k, v in own.items()}
    tx.step(own, squares, counts, texts, labels, {})
    for name, at in (("base", 0), ("words", tx.features("bad")[0]), ("words", tx.features("calm")[0])):
        moved = {k: v.copy() for k, v in start.items()}
        moved[name][at] += 1e-6
        slope = (loss(moved) - loss(start)) / 1e-6 + (tx.DECAY * start[name][at] if name == "words" else 0)
        assert abs(np.sqrt(squares[name][at]) - abs(slope)) < 1e-4


def data(spark, n=600):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        parts = [" ".join(f"w{rng.integers(60)}" for _ in range(6)) for _ in range(rng.integers(1, 8))]
        if toxic:
            parts[rng.integers(len(parts))] += rng.choice([" vile", " rottenest", " rottenly"])
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, toxic))
    return (spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, score string, label int"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(rows), dict(labels))


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels, texts, truth = data(spark)
    return tx.train(docs, labels.where(~tx.held_out(F.col("doc_id")))), docs, texts, truth


def test_held_out_accuracy(trained):
    weights, docs, _, truth = trained
    rows = tx.score(docs, weights).withColumn("held", tx.held_out(F.col("doc_id"))).where("held").collect()
    assert len(rows) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95


def test_offending_sentences_are_located(trained):
    weights, docs, texts, truth = trained
    hits = [(r, [texts[r.doc_id][s.start:s.end] for s in r.offending]) for r in tx.score(docs, weights).collect() if truth[r.doc_id]]
    right = [all("vile" in p or "rotten" in p for p in parts) and parts for _, parts in hits]
    assert np.mean([bool(x) for x in right]) > 0.9


def slow_score(text, weights):
    """One minus the product of what each sentence leaves, sentences and words read letter by letter."""
    def beginnings(word):
        return [word] + [f"{k}{word[:k]}" for k in (3, 4, 5, 6, 7) if len(word) > k]

    sentences, clean = "".join("\n" if c in ".!?" else c for c in text or "").split("\n"), 1.0
    for sentence in sentences:
        words = set("".join(c if c.isalpha() else " " for c in sentence.lower()).split())
        if words or sentences == [""]:
            z = float(weights["base"][0])
            for w in words:
                for b in beginnings(w):
                    z += float(weights["words"][zlib.crc32(b.encode()) % 2**18])
            clean *= 1 / (1 + math.exp(z))
    return 1 - clean


def test_scores_equal_a_slow_noisy_or(spark, trained):
    weights, docs, texts, _ = trained
    extra = {1000: "Vile! w1 w2? Rottenest\nW3 vile, 7 w4", 1001: "Größe rottenly; 漢字 vile... w9", 1002: ""}
    found = docs.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    for r in tx.score(found, weights).collect():
        assert r.score == pytest.approx(slow_score({**texts, **extra}[r.doc_id], weights), abs=1e-6)


def test_scores_edge_cases(spark, trained):
    weights = trained[0]
    rows = [(1, None), (2, ""), (3, "... 123"), (None, "w1 vile."), (4, "w1 vile."), (4, "w1 vile."), (5, "w1 " * 50000 + "vile")]
    got = tx.score(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string"), weights).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got) and by[1] == by[2] == by[3] and by[None] == by[4] > 0.5
    assert tx.score(spark.createDataFrame([], "doc_id long, text string"), weights).count() == 0


def test_labels_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 1), (2, 7)], "doc_id long, toxic int")
    assert tx.train(docs, odd)["base"][0] != tx.START
    none = tx.train(docs, odd.where("doc_id > 10"))
    assert none["base"][0] == np.float32(tx.START) and not none["words"].any()


def test_sample_is_bounded_and_blind_to_order(spark):
    docs, labels, _, _ = data(spark, 200)
    one = tx.train(docs, labels, most=50)
    two = tx.train(docs.orderBy(F.desc("doc_id")), labels.orderBy(F.desc("doc_id")), most=50)
    assert np.allclose(one["words"], two["words"])


def test_moves_are_averaged_by_counts(spark):
    frame = spark.createDataFrame([(1.0, 1), (3.0, 3)], "x double, n int").repartition(2, "n")

    def learn(weights, batches):
        rows = [r for b in batches for r in b.to_pylist()]
        if not rows:
            return None
        n = np.array([sum(r["n"] for r in rows), 0.0])
        return {"w": np.array([sum(r["x"] * r["n"] for r in rows) / n[0], 9.0])}, {"w": n}

    assert mixing.mix(frame, {"w": np.zeros(2)}, learn)["w"][0] == pytest.approx(2.5, abs=1e-2)
    assert mixing.mix(frame.where("n > 9"), {"w": np.ones(2)}, learn)["w"].tolist() == [1, 1]


def test_query_on_the_whole_table(spark):
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op9_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) > 0.85
