import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyscore.llm import maxent_lm as lm

ROWS = [
    (1, "The cat sat. The CAT sat\x0bdown"), (2, "the cat"), (3, None), (4, ""), (5, " \t\n"), (6, "É é\x85x  nbsp\x1cw"),
    (7, "word " * 4000), (8, "never seen before"), (8, "never seen before"), (None, "the dog"), (10, "x" * 5000 + " the"),
    *[(100 + i, f"the cat sat on mat number {i % 7}") for i in range(40)],
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1.0, 0) for i, t in rows], "doc_id long, text string, score string, row double, id int")


def expected(rows):
    tokens = lambda t: [w.encode() for w in split(t)] + [b""]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out.append((i, held(i), len(ws), sum(w in counts for w in ws), n, round(base, 6)))
    return out


def split(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def got(df):
    return [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 3])
def test_counts_and_base_score(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    df = lm.score(frame(spark, ROWS), lm.held_out(F.col("doc_id")))
    assert sorted(got(df), key=repr) == sorted(expected(ROWS), key=repr)
    scores = [r.score for r in df.collect()]
    assert all(s < 0 and math.isfinite(s) for s in scores)


def test_score_does_not_depend_on_the_size_of_the_table(spark, monkeypatch):
    held = lm.held_out(F.col("doc_id"))
    one = {(r.doc_id, r.n_tokens): r.score for r in lm.score(frame(spark, ROWS).coalesce(1), held).collect()}
    monkeypatch.setattr(lm, "FREQUENT", 40)
    two = {(r.doc_id, r.n_tokens): r.score for r in lm.score(frame(spark, ROWS).coalesce(1), held).collect()}
    assert one.keys() == two.keys()


def test_probabilities_sum_to_one(spark):
    counts = spark.createDataFrame([(b"", 50), *[(f"w{i}".encode(), 3000 - i) for i in range(2000)]], "word binary, n long")
    vocabulary = lm.Vocabulary(counts)
    weights = vocabulary.weights()
    rng = np.random.default_rng(1)
    weights["class"] += rng.standard_normal(weights["class"].shape).astype(np.float32)
    weights["word"] += rng.standard_normal(weights["word"].shape).astype(np.float32)
    ids = np.arange(lm.NOTHING)  # all model words and ending classes after one history
    total = sum(10.0 ** (lm.log10_probability(weights, [np.array([7, 9, i], np.uint16)])[0]
                         - lm.log10_probability(weights, [np.array([7, 9], np.uint16)])[0]) for i in ids)
    assert abs(total - 1) < 1e-3
    listed = {w: n for w, n in counts.collect()}
    top = set(vocabulary.frequent[:lm.MODEL_WORDS])
    for e in range(lm.ENDINGS):
        mine = [n for w, n in listed.items() if bytes(w) not in top and lm.ending(bytes(w)) == e]
        share = sum((n + 0.1) / vocabulary.ending_shares[e] for n in mine) + 0.1 / vocabulary.ending_shares[e]
        assert abs(share - 1) < 1e-9


def test_training_beats_the_base_on_held_out_texts(spark):
    rows = [(i, " ".join(("a b c d e f g h".split() * 9)[i % 8:][:40])) for i in range(400)]
    df = lm.score(frame(spark, rows), lm.held_out(F.col("doc_id"))).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert df[2] > 10 and df[0] > df[1] * 0.7


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(2)
    table, base = rng.standard_normal((8, 4)).astype(np.float64), np.zeros(4)
    features, label = [np.array([1]), np.array([1]), np.array([5])], 2
    loss = lambda t: -np.log(lm.softmax(lm.logits_of(t, base, features))[0, label])
    slopes = lm.softmax(lm.logits_of(table, base, features))
    slopes[0, label] -= 1
    for r, times in ((1, 2), (5, 1)):
        for c in range(4):
            moved = table.copy()
            moved[r, c] += 1e-6
            assert abs((loss(moved) - loss(table)) / 1e-6 - times * slopes[0, c]) < 1e-4


def test_empty_table_and_no_training_rows(spark):
    assert lm.score(frame(spark, []), lm.held_out(F.col("doc_id"))).count() == 0
    rows = [(1, "a b"), (2, None)]
    df = lm.score(frame(spark, rows), F.lit(True))
    assert [(r.n_known, r.train_tokens, r.base_score) for r in df.orderBy("doc_id").collect()] == [(0, 0, 0.0), (0, 0, 0.0)]


def test_query_on_the_whole_table(spark):
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = QUERIES["op2_lm_score"](spark, sf)
    assert sorted(got(df), key=repr) == sorted(expected(rows), key=repr)


def counted(spark, extra=()):
    rows = [(b"", 50), *[(f"w{i}".encode(), 9000 - i) for i in range(3000)], *extra]
    return lm.Vocabulary(spark.createDataFrame(rows, "word binary, n long"))


def test_words_beyond_the_first_classes_are_leaves_that_sum_to_one(spark):
    vocabulary = counted(spark)
    weights = vocabulary.weights()
    rng = np.random.default_rng(3)
    for k in ("class", "word", "tree"):
        weights[k] += rng.standard_normal(weights[k].shape).astype(np.float32)
    assert len(set(vocabulary.codes.tolist())) == len(vocabulary.frequent) == 3001
    ends = [lm.rare_code(b"q") & ~(15 << lm.HASH) | e << lm.HASH for e in range(lm.ENDINGS)]  # a word beyond the table in each ending
    texts = [np.array([7, 9, i], np.uint32) for i in [*vocabulary.codes.tolist(), *ends]]
    both = lm.log10_probability(weights, texts) - lm.log10_probability(weights, [np.array([7, 9], np.uint32)])[0]
    assert abs((10.0 ** both).sum() - 1) < 1e-3


def test_histories_of_less_frequent_words_differ_and_teach(spark):
    pa = lm.pa
    vocabulary = counted(spark)
    code = dict(zip(vocabulary.frequent, vocabulary.codes.tolist()))
    a, b, c = code[b"w2500"], code[b"w2900"], code[b"w2901"]
    rare = [lm.rare_code(w) for w in (b"aaxyz", b"bbxyz")]  # one ending
    assert lm.ending(b"aaxyz") == lm.ending(b"bbxyz") and rare[0] != rare[1]
    weights = vocabulary.weights()
    texts = [np.array(pair, np.uint32).tobytes() for pair in [(a, b), (rare[0], b), (rare[1], c)]] * 3000
    batch = pa.RecordBatch.from_pydict({"ids": pa.array(texts, pa.binary())})
    for _ in range(4):
        moves, _ = lm.learn(weights, [batch])
        weights = {k: w + moves[k] for k, w in weights.items()}
    last = lambda x, y: (lm.log10_probability(weights, [np.array([x, y], np.uint32)]) - lm.log10_probability(weights, [np.array([x], np.uint32)]))[0]
    assert last(a, b) > last(a, c) + 0.5
    assert last(rare[0], b) > last(rare[0], c) + 0.5 and last(rare[1], c) > last(rare[1], b) + 0.5


def test_scores_are_the_same_whatever_room_the_table_has_left(spark, monkeypatch):
    held = lm.held_out(F.col("doc_id"))
    words = len({w for i, t in ROWS if zlib.crc32(str("" if i is None else i).encode()) % 10 for w in lm.tokens_of(t or "")})
    scores = []
    for room in (lm.FREQUENT, words):
        monkeypatch.setattr(lm, "FREQUENT", room)
        scores.append(sorted((repr(r.doc_id), r.n_tokens, round(r.score, 6)) for r in lm.score(frame(spark, ROWS).coalesce(1), held).collect()))
    assert scores[0] == scores[1]


def test_feature_tables_follow_the_counts(spark):
    assert len(counted(spark).weights()["tree"]) == 1 << 15
    assert len(counted(spark, [(b"more", 1 << 40)]).weights()["class"]) == 1 << lm.ROW_BITS[1]


def slow_log10(weights, codes):
    """One text's log10 probability, token by token and outcome by outcome."""
    import math

    def mixed(kind, key):
        x = (key + (kind << 40)) * 0x9E3779B97F4A7C15 % 2**64
        x ^= x >> 29
        return x * 0xBF58476D1CE4E5B9 % 2**64 >> 32

    def factor(name, base, features, label):
        table = weights[name]
        logits = [float(base[k]) + sum(float(table[f >> (33 - len(table).bit_length())][k]) for f in features) for k in range(table.shape[1])]
        return math.log10(math.exp(logits[label]) / sum(map(math.exp, logits)))

    def joined(features, node):
        own = (node * 0x9E3779B1 + 0x7F4A7C15) % 2**32
        return [(f ^ own) * 0x85EBCA77 % 2**32 for f in features]

    total, one, two, fan = 0.0, lm.NOTHING, lm.NOTHING, weights["tree"].shape[1]
    for c in map(int, codes):
        features = [mixed(1, one), mixed(2, (one + two * 0xC2B2AE3D27D4EB4F) % 2**64), mixed(3, two)]
        if c < lm.MODEL_WORDS:
            kind, label = c // lm.SIZE, c % lm.SIZE
            total += factor("word", weights["word_base"][kind], joined(features, kind), label)
        else:
            e = (c >> lm.HASH if c >= lm.RARE else c >> lm.LEAF) % lm.ENDINGS
            leaf, kind = 0 if c >= lm.RARE else c % 2**lm.LEAF, lm.CLASSES + e
            first = e * fan + leaf // fan**2
            for node, branch in ((e, leaf // fan**2), (lm.ENDINGS + first, leaf // fan % fan),
                                 (lm.ENDINGS * (1 + fan) + first * fan + leaf // fan % fan, leaf % fan)):
                total += factor("tree", weights["tree_base"][node], joined(features, node), branch)
        total += factor("class", weights["class_base"][0], features, kind)
        one, two = c, one
    return total


def test_scores_equal_a_slow_scorer(spark):
    vocabulary = counted(spark)
    weights, rng = vocabulary.weights(), np.random.default_rng(9)
    for k in ("class", "word", "tree"):
        weights[k] += rng.standard_normal(weights[k].shape).astype(np.float32)
    words = [*rng.choice(vocabulary.codes, 60), *(lm.rare_code(f"zz{k}".encode()) for k in range(20))]
    texts = [np.array(rng.permutation(words)[:n], np.uint32) for n in (1, 2, 7, 40)]
    assert np.allclose(lm.log10_probability(weights, texts), [slow_log10(weights, t) for t in texts], atol=1e-3)


def test_moves_are_averaged_block_by_block():
    from surveyscore.llm import mixing

    rng = np.random.default_rng(1)
    tasks = []
    for t in range(3):
        n = {"a": rng.integers(0, 3, 2500).astype(np.float32), "b": np.zeros(5, np.float32)}
        n["a"][1024:2048] = 0  # a block that no task touched
        tasks.append(({"a": rng.standard_normal((2500, 4)).astype(np.float32), "b": np.zeros(5, np.float32)}, n))
    rows = [(k.as_py(), b.as_py(), t, batch) for t, (x, n) in enumerate(tasks) for batch in mixing.moved(x, n, t)
            for k, b in [(batch.column(0)[0], batch.column(1)[0])]]
    got = {(r.column(0)[0].as_py(), r.column(1)[0].as_py()): np.frombuffer(r.column(2)[0].as_py(), np.float32).reshape(-1, 4)
           for r in mixing.averaged(r[3] for r in sorted(rows, key=lambda r: r[:3]))}
    assert sorted(got) == [(0, 0), (0, 2)]
    weight = sum(n["a"] for _, n in tasks)
    mean = sum(x["a"] * n["a"][:, None] for x, n in tasks) / np.maximum(weight, 1e-9)[:, None]
    assert np.allclose(np.concatenate([got[0, 0], got[0, 2]]), np.concatenate([mean[:1024], mean[2048:]]), atol=2e-3)


def test_no_power_is_taken_for_a_token(spark, monkeypatch):
    vocabulary = counted(spark)
    weights, rng, taken, exp = vocabulary.weights(), np.random.default_rng(4), [], np.exp
    texts = [rng.choice(vocabulary.codes, 500) for _ in range(300)]
    batch = lm.pa.RecordBatch.from_pydict({"ids": lm.pa.array([t.tobytes() for t in texts], lm.pa.binary())})
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: taken.append(np.size(x)) or exp(x, *a, **k))
    size = sum(t.size for t in weights.values())
    lm.learn(weights, [batch])
    assert sum(taken) <= size
    taken.clear()
    lm.log10_probability(weights, texts)
    assert sum(taken) <= size


def test_words_of_many_texts_are_those_of_each(spark):
    odd = "".join(map(chr, range(256)))
    texts = [None, "", " \t\n", "A b", " x\x0by\x1cz ", odd, odd * 3, "É é\x85 İ", "\x00 \x00", "a" * 9000]
    for chosen in (texts, texts[:3], []):
        words, sizes = lm.words_of(lm.pa.array(chosen, lm.pa.string()))
        each = [lm.tokens_of(t or "")[:-1] for t in chosen]
        assert words.cast(lm.pa.binary()).to_pylist() == [w for t in each for w in t]
        assert sizes.tolist() == list(map(len, each))


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 3])
def test_codes_and_words_beyond_the_table(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    texts = frame(spark, ROWS).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), F.lit(False).alias("held"), "text")
    vocabulary = lm.Vocabulary(lm.count_words(texts.where("id % 2 = 0")))
    code = dict(zip(vocabulary.frequent, vocabulary.codes.tolist()))
    rows = lm.encode(texts, vocabulary).join(texts.select("row", "text"), "row").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        tokens = lm.tokens_of(r.text or "")
        beyond = Counter(w for w in tokens if w not in code)
        assert np.frombuffer(r.ids, np.uint32).tolist() == [code.get(w, lm.rare_code(w)) for w in tokens]
        assert sorted((bytes(x.word), x.n, x.ending) for x in r.rest) == sorted((w, n, lm.ending(w)) for w, n in beyond.items())
        assert (r.n_tokens, r.known) == (len(tokens), len(tokens) - sum(beyond.values()))


def test_products_are_the_powers_of_sums():
    rng = np.random.default_rng(5)
    table, base = rng.standard_normal((64, 8)).astype(np.float32), rng.standard_normal(8).astype(np.float32)
    features = [rng.integers(0, 64, 30).astype(np.uint16) for _ in range(3)]
    products = lm.products_of(np.exp(table), features) * np.exp(base)
    assert np.allclose(lm.shares_of(products), lm.softmax(lm.logits_of(table, base, features)), atol=1e-6)


def test_slopes_of_a_row_are_added_however_often_it_is_touched():
    rng = np.random.default_rng(6)
    for n in (1, 5, 700):
        features = [(rng.zipf(1.3, n) % 500).astype(np.uint16) for _ in range(3)]
        slopes = rng.standard_normal((n, 6)).astype(np.float32)
        rows, sums = lm.slopes_by_row(features, slopes)
        slow = np.zeros((500, 6))
        for f in features:
            np.add.at(slow, f, slopes)
        assert sorted(rows.tolist()) == sorted(set(np.concatenate(features).tolist()))
        assert np.allclose(sums, slow[rows], atol=1e-3)


def test_a_step_is_that_of_adagrad_on_the_weights():
    rng = np.random.default_rng(7)
    weights = rng.standard_normal((50, 4)).astype(np.float32)
    powers, seen = np.exp(weights), np.ones(50, np.complex64)
    squares, times = np.ones(50), np.zeros(50)
    for _ in range(3):
        features, slopes = [rng.integers(0, 40, 25).astype(np.uint16) for _ in range(3)], rng.uniform(-1, 1, (25, 4)).astype(np.float32)
        lm.descend(powers, seen, features, slopes)
        g = np.zeros((50, 4))
        for f in features:
            np.add.at(g, f, slopes)
        squares += (g * g).mean(axis=1)
        times += (g != 0).any(axis=1)
        weights = weights - lm.RATE * g / np.sqrt(squares)[:, None]
    assert np.allclose(np.log(powers), weights, atol=3e-3) and np.allclose(np.log(powers)[40:], weights[40:], atol=1e-6)
    assert np.allclose(seen.real, squares, rtol=1e-5) and np.array_equal(seen.imag, times)


def test_totals_of_endings_count_short_words(spark):
    words = {b"": 9, b"a": 5, b"ab": 4, b"abc": 3, b"xabc": 2, "né".encode(): 7, b"\xff\x00\x80\x7f": 6}
    vocabulary = lm.Vocabulary(spark.createDataFrame([*words.items(), *[(f"w{i}".encode(), 99) for i in range(lm.MODEL_WORDS)]], "word binary, n long"))
    slow = np.zeros(lm.ENDINGS)
    for w, n in words.items():
        slow[lm.ending(w)] += n
    assert np.array_equal(vocabulary.ending_tokens, slow)


def test_steps_are_the_same_in_windows_of_any_size(spark, monkeypatch):
    vocabulary = counted(spark)
    weights, text = vocabulary.weights(), np.random.default_rng(8).choice(vocabulary.codes, 3000)
    batch = lm.pa.RecordBatch.from_pydict({"ids": lm.pa.array([text.tobytes()], lm.pa.binary())})
    monkeypatch.setattr(lm, "STEP", 64)
    found = []
    for window in (64, 128, 6400):
        monkeypatch.setattr(lm, "WINDOW", window)
        found.append(lm.learn(weights, [batch]))
    for moves, counts in found[1:]:
        assert all(np.allclose(moves[k], found[0][0][k], atol=1e-6) and np.array_equal(counts[k], found[0][1][k]) for k in weights)
