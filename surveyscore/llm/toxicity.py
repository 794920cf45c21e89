"""Toxicity by multiple-instance learning.

A document is toxic if one of its sentences is. Each sentence has a probability from a linear model
over hashed words and word beginnings; a document's is their noisy-or. The model is trained on
document labels alone, and the sentence probabilities then say which sentences offend.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyscore.llm.batches import map_texts, once_per_worker, text_list
from surveyscore.llm.mixing import Tables, mix
from surveyscore.llm.store import store

TRAINING_ROWS = 16_384  # most labelled rows that the classifier is fitted on: those of least hash
BUCKETS = 1 << 18  # of hashed features
BEGINNINGS = (3, 4, 5, 6, 7)  # lengths of word beginnings used beside the whole word
ROUNDS = 4
PARTS = 4  # learners of a round; the sample is bounded, so their number is fixed
BATCH = 32  # documents of a gradient step
STEPS = 128  # of a learner in a round: one pass over its share of a full sample
RATE = 0.2
DECAY = 1e-3
START = -6.5  # log odds of a sentence without known words, before training
CACHED = 100_000  # words of a worker's cache; a full cache starts anew
TRAINING_CACHED = 30_000  # likewise while training, where a word holds its features
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    found = [zlib.crc32(word.encode())]
    found += [zlib.crc32(b"%d" % k + word[:k].encode()) for k in BEGINNINGS if len(word) > k]
    return [f & (BUCKETS - 1) for f in found]


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """Start, end and distinct words (lower case) of each sentence that has a word."""
    out = []
    for m in SENTENCE.finditer(text):
        words = set(WORD.findall(m.group().lower()))
        if words:
            out.append((*m.span(), words))
    return out


def training_arrays(texts: list[str], cache: dict[str, list[int]]):
    """Feature ids, where each sentence starts among them, where each document among sentences.

    A document without words is one sentence without features, held by one id past the buckets.
    """
    ids, sentence_at, document_at = [], [], []
    for text in texts:
        document_at.append(len(sentence_at))
        for words in [w for _, _, w in sentences(text)] or [()]:
            sentence_at.append(len(ids))
            for w in sorted(words):
                if w not in cache:
                    if len(cache) >= TRAINING_CACHED:
                        cache.clear()
                    cache[w] = features(w)
                ids += cache[w]
            if not words:
                ids.append(BUCKETS)
    return np.array(ids), np.array(sentence_at), np.array(document_at)


def step(weights: Tables, squares: Tables, counts: Tables, texts: list[str], labels: np.ndarray, cache: dict) -> None:
    """One Adagrad step on the noisy-or likelihood, in place."""
    ids, sentence_at, document_at = training_arrays(texts, cache)
    w, b = weights["words"], weights["base"]
    z = np.add.reduceat(np.append(w, 0.0)[ids], sentence_at) + b[0]
    p = 1 / (1 + np.exp(-z))
    clean = np.add.reduceat(np.logaddexp(0, z), document_at)  # minus log probability of no offence
    toxic = np.maximum(-np.expm1(-clean), 1e-9)
    pull = np.where(labels == 1, -(1 - toxic) / toxic, 1.0)
    slope = p * np.repeat(pull, np.diff(np.append(document_at, len(z))))
    slopes = np.repeat(slope, np.diff(np.append(sentence_at, len(ids))))
    known = ids < BUCKETS
    rows, where = np.unique(ids[known], return_inverse=True)
    g = np.bincount(where, weights=slopes[known], minlength=len(rows)) + DECAY * w[rows]
    for name, at, grad in (("words", rows, g), ("base", np.zeros(1, int), np.array([slope.sum()]))):
        squares[name][at] += grad * grad
        weights[name][at] -= RATE * grad / np.sqrt(squares[name][at])
        counts[name][at] += 1


def learner(seed: int):
    def learn(weights: Tables, batches):
        rows = [(t, y) for b in batches for t, y in zip(text_list(b.column(0)), b.column(1).to_pylist())]
        if not rows:
            return None
        own = {k: v.astype(np.float64) for k, v in weights.items()}
        squares = {"words": np.full(BUCKETS, 1e-3), "base": np.ones(1)}
        counts, cache = {k: np.zeros(len(v)) for k, v in own.items()}, {}
        rng = np.random.default_rng(seed)
        order = np.concatenate([rng.permutation(len(rows)) for _ in range(1 + STEPS * BATCH // len(rows))])
        for at in range(0, STEPS * BATCH, BATCH):
            picked = [rows[i] for i in order[at:at + BATCH]]
            step(own, squares, counts, [t for t, _ in picked], np.array([y for _, y in picked]), cache)
        return {k: own[k] - weights[k] for k in own}, counts

    return learn


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", most: int = TRAINING_ROWS) -> Tables:
    """Weights from documents with a label 0 or 1.

    At most ``most`` labelled ids are used, those of least hash, which is a sample without regard
    to order or size; ids without a text among ``docs`` are ignored, and an id labelled twice
    counts once, toxic if either label says so. Without usable rows the model stays at its start.
    """
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(most))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(store(picked, "labels")), "id").dropDuplicates(["id"])
    rows = store(rows.select(F.xxhash64("id").alias("at"), "text", "label")
                 .repartition(PARTS, "at").sortWithinPartitions("at").select("text", "label"), "training")
    weights = {"words": np.zeros(BUCKETS, np.float32), "base": np.full(1, START, np.float32)}
    for k in range(ROUNDS):
        weights = mix(rows, weights, learner(k))
    return weights


class Words(dict):
    """Weight of a word, worked out when first asked for."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED:
            self.clear()
        value = self[word] = float(self.weights[features(word)].sum())
        return value


def noisy_or(logits: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def score(docs: DataFrame, weights: Tables, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """Toxicity of every whole text.

    Returns one row per input row: the id, score (0 to 1), predicted (1 if score >= 0.5) and
    offending, the sentences whose own probability reaches ``threshold``: start and end in code
    points, and the probability. ``keep_text`` adds the text. A null or empty text, or one without words, counts as one
    sentence without words. Null ids, repeated rows and an empty table pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    least, key = float(np.log(threshold / (1 - threshold))), uuid.uuid4().hex

    def prepare():
        known = once_per_worker(key, lambda: Words(shared.value["words"]))
        base = float(shared.value["base"][0])

        def work(texts):
            scores, found = [], []
            for text in texts:
                parts = sentences(text)
                logits = np.array([base + sum(map(known.__getitem__, w)) for _, _, w in parts] or [base])
                scores.append(noisy_or(logits))
                found.append([{"start": parts[i][0], "end": parts[i][1], "probability": float(1 / (1 + np.exp(-logits[i])))}
                              for i in np.flatnonzero(logits >= least) if parts])
            return [scores, [int(s >= 0.5) for s in scores], found]

        return work

    return map_texts(docs, id_col, text_col,
                     "score double, predicted int, offending array<struct<start:int,end:int,probability:double>>", prepare, keep_text)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == 0
