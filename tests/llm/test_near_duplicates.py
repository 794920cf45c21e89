import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyscore.llm import components as cc
from surveyscore.llm import embedding_dedup as ed
from surveyscore.llm import minhash_dedup as mh
from surveyscore.llm.grouped import sorted_groups


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    n = 300
    links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(200)] + [(i, i + 1) for i in range(40)] + [(250, i) for i in range(100, 140)]
    want = groups(n, links)
    df = cc.connected_components(spark.createDataFrame([*links, (None, 3), (7, 7)], "a long, b long"))
    got = {r.node: r.component for r in df.collect()}
    assert [got.get(i, i) for i in range(n)] == want
    assert cc.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- texts -------------------------------------------------------------------------------


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, h string, cid int, n int")


def brute_texts(rows, percent):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    ids = [i for i, _ in rows]
    links = []
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if ids[x] is None or ids[y] is None:
                continue
            if ids[x] == ids[y] or both and 100 * both >= percent * len(sets[x] | sets[y]):
                links.append((x, y))
    root = groups(len(rows), links)
    least = {r: min(ids[i] for i in range(len(rows)) if root[i] == r) for r in set(root) if ids[r] is not None}
    return sorted(((ids[i], len(sets[i]), least.get(root[i]), ids[i] is None or ids[i] == least[root[i]]) for i in range(len(rows))), key=repr)


def near_texts(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows, base = [], []
    for i in range(n):
        if base and rnd.random() < 0.7:
            t = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                t[rnd.randrange(len(t))] = rnd.choice(words)
        else:
            t = [rnd.choice(words) for _ in range(rnd.randint(20, 90))]
        base.append(t)
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("percent,block", [(85, mh.BLOCK), (80, 3)])
def test_texts_equal_brute_force(spark, monkeypatch, percent, block):
    monkeypatch.setattr(mh, "BLOCK", block)
    rows = near_texts(percent)
    got = mh.near_duplicates(documents(spark, rows), percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_texts(rows, percent)


def test_text_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo "), (6, "one two three"), (7, "é É a b c"), (8, "é É a b c"),
            (9, "x"), (9, "y"), (10, "y"), (None, "one two"), (12, "long " * 20000 + "end"), (13, "long " * 19000 + "end"), (4, "one two")]
    got = mh.near_duplicates(documents(spark, rows), percent=85).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_texts(rows, 85)
    assert mh.near_duplicates(documents(spark, [])).count() == 0


def test_a_bucket_of_several_components_is_searched_whole(spark):
    rows = [(i, " ".join(f"a{j}" for j in range(60)) + f" tail{i} t{i} u{i}") for i in range(12)]
    rows += [(100 + i, " ".join(f"a{j}" for j in range(45)) + " " + " ".join(f"b{j}" for j in range(18 + i % 3))) for i in range(12)]
    got = mh.near_duplicates(documents(spark, rows), percent=85).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_texts(rows, 85)


def test_links_that_no_leader_shows_are_found(spark, monkeypatch):
    """With leaders that link to nothing, the search of mixed buckets alone gives the components."""
    rows = near_texts(3, 120)
    with monkeypatch.context() as m:
        m.setattr(mh, "BLOCK", 7)
        m.setattr(mh, "leader_pairs", lambda shared: shared.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0))
        got = mh.near_duplicates(documents(spark, rows), percent=80).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_texts(rows, 80)


def test_texts_are_looked_up_by_one_python_node(spark, monkeypatch):
    """Two in a stage hold two workers a task, all of which later stages fill with their own tables."""
    plans, store = {}, mh.store

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(mh, "store", noted)
    docs = spark.createDataFrame([(i, f"text {i}" if i % 9 else None) for i in range(500)], "doc_id long, text string")
    texts = [(i, t, *mh.sequence_hash(mh.words_of(t or ""))) for i, t in docs.collect()]
    classes = spark.createDataFrame([(i + 1000, i, h, g) for i, t, h, g in texts if t], "cid long, id long, h long, g long")
    asked = spark.createDataFrame([(i + 1000,) for i in range(0, 500, 7)], "cid long")
    found = mh.Texts(docs, classes, "doc_id", "text").of(asked)
    assert sorted(map(tuple, found.collect())) == [(i + 1000, t) for i, t, _, _ in texts if t and i % 7 == 0]
    assert sum(plans["texts"].count(node) for node in ("EvalPython", "MapInArrow")) == 1


def test_bits_of_the_filter(spark):
    rng = np.random.default_rng(1)
    marks = rng.integers(-(1 << 63), 1 << 63, (300, 2), np.int64)
    want = np.zeros(1 << 12, np.uint8)
    want[marks.ravel() & ((1 << 12) - 1)] = 1
    table = mh.bit_table(spark.createDataFrame(marks.tolist(), "at0 long, at1 long"), 1 << 12)
    assert (np.unpackbits(np.frombuffer(table, np.uint8), bitorder="little") == want).all()
    assert all(mh.has_bit(np.frombuffer(table, np.uint8), marks[:, 0], 1 << 12))
    assert not any(mh.bit_table(spark.createDataFrame([], "at0 long, at1 long"), 1 << 10))


def test_groups_of_a_sorted_partition():
    batches = [pa.RecordBatch.from_pydict({"k": k, "l": [0] * len(k), "v": k}) for k in ([1, 1, 2], [2, 2], [], [2, 3, 4], [5], [5, 5])]
    got = [g.column(2).to_pylist() for g in sorted_groups(iter(batches), 2)]
    assert got == [[1, 1], [2, 2, 2, 2], [3], [4], [5, 5, 5]]


def test_signatures_estimate_the_similarity():
    factors, shifts = mh.family(400)
    a, b = mh.shingle_hashes([b"%d" % i for i in range(1000)]), mh.shingle_hashes([b"%d" % i for i in range(100, 1100)])
    share = (mh.signature(a, factors, shifts) == mh.signature(b, factors, shifts)).mean()
    assert abs(share - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.1


# ---- vectors -----------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, "clash") for i, v in rows], "vec_id long, embedding array<float>, cid int, root string")


def brute_vectors(rows, cosine):
    ok = [i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    links, count = [], [0] * len(rows)
    for x in range(len(rows)):
        for y in range(x):
            if rows[x][0] is not None and rows[x][0] == rows[y][0]:
                if ok[x] and ok[y]:
                    links.append((x, y))
            if ok[x] and ok[y] and len(rows[x][1]) == len(rows[y][1]):
                a, b = (np.array(rows[z][1], np.float32).astype(float) for z in (x, y))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links.append((x, y))
                    count[x] += 1
                    count[y] += 1
    root = groups(len(rows), links)
    ids = [i for i, _ in rows]
    least = {r: min(ids[i] for i in range(len(rows)) if root[i] == r) for r in set(root) if ids[r] is not None}
    return sorted(((ids[i], count[i], least.get(root[i]), ids[i] is None or ids[i] == least[root[i]]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("block,tile,copy", [(8192, 512, 1024), (40, 16, 1024), (8192, 512, 4), (20, 8, 4)])
def test_vectors_equal_brute_force(spark, monkeypatch, block, tile, copy):
    """One cell, one cell of many blocks, cells of many groups, and those in blocks."""
    monkeypatch.setattr(ed, "BLOCK", block)
    monkeypatch.setattr(ed, "TILE", tile)
    monkeypatch.setattr(ed, "COPY", copy)
    assert (ed.plan_groups(290, 0.9, ed.RECALL)[1] > 5) == (copy == 4)
    rng = np.random.default_rng(block)
    rows, held = [], []
    for i in range(260):
        v = rng.standard_normal(24) if not held or rng.random() < 0.5 else held[rng.integers(len(held))] + rng.standard_normal(24) * rng.choice([0, 0.05, 0.3, 0.45])
        held.append(v)
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(300 + i, rows[5][1]) for i in range(30)]
    got = ed.near_duplicates(vectors(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_vectors(rows, 0.9)


def test_vector_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0]), (10, [0.0, -1.0]), (11, [0.0, -3.0]), (7, [1.0, 0.0]), (12, [-1.0, 0.0])]
    got = ed.near_duplicates(vectors(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_vectors(rows, 0.9)
    assert ed.near_duplicates(vectors(spark, [])).count() == 0


def test_calibrated_count_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    x = ed.unit(rng.standard_normal((4000, 32)))
    y = ed.unit(rng.standard_normal((4000, 32)))
    y = ed.unit(y - (x * y).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    half = ed.WIDTH * np.sqrt(0.2)
    count = (np.abs(ed.project(x, ed.LINES) - ed.project(y, ed.LINES)) <= half).sum(1)
    assert (count >= ed.calibrate(ed.LINES, ed.WIDTH, ed.RECALL)).mean() > 0.999


def pairs_at(cosine, n, length, seed):
    rng = np.random.default_rng(seed)
    x, y = ed.unit(rng.standard_normal((n, length))), rng.standard_normal((n, length))
    return x, cosine * x + np.sqrt(1 - cosine**2) * ed.unit(y - (x * y).sum(1, keepdims=True) * x)


def test_recall_of_vectors_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(ed, "COPY", 16)
    x, y = pairs_at(0.9001, 2000, 48, 8)
    data = [(2 * k + side, [float(c) for c in v]) for k in range(2000) for side, v in enumerate((x[k], y[k]))]
    assert ed.plan_groups(4000, 0.9, ed.RECALL)[0] > 4
    found = {r.vec_id: r.component_id for r in ed.near_duplicates(vectors(spark, data)).collect()}
    assert np.mean([found[2 * k + 1] == 2 * k for k in range(2000)]) > 0.99


def test_cells_keep_their_recall_where_vectors_share_a_direction():
    """The middle of a line parts a pair by its angle alone, also in a narrow cone."""
    x, y = pairs_at(0.9, 4000, 32, 9)
    lean = np.zeros(32)
    lean[0] = 4
    x = ed.unit(x + lean)
    y = ed.unit(np.random.default_rng(1).standard_normal((4000, 32)))
    y = 0.9 * x + np.sqrt(0.19) * ed.unit(y - (x * y).sum(1, keepdims=True) * x)
    g, groups = ed.plan_groups(100_000, 0.9, ed.RECALL)
    assert (ed.cell_keys(x, g, groups) == ed.cell_keys(y, g, groups)).any(axis=1).mean() > 0.997


def test_comparisons_grow_less_than_the_power_of_one_point_three():
    def work(n):
        g, groups = ed.plan_groups(n, 0.9, ed.RECALL)
        return groups * (ed.COPY + n / 2**g) * n

    assert all(work(10 * n) < work(n) * 10**1.3 for n in (10**5, 10**6, 10**7, 10**8))


def test_a_pair_of_vectors_counts_once_and_only_if_it_never_met():
    x, y = pairs_at(0.95, 30, 16, 3)
    v, ones = np.concatenate([x, y]), np.ones(60, np.int64)
    none = np.zeros((60, 0), np.int32)
    linked, _ = ed.compare(v, ones, none, 60, True, 0.9, ed.LINES, 1e-4)
    assert linked[:30].min() >= 1
    met = np.arange(60, dtype=np.int32)[:, None] % 30 % 10  # partners met if this is equal
    later, _ = ed.compare(v, ones, met, 60, True, 0.9, ed.LINES, 1e-4)
    apart, _ = ed.compare(v, ones, np.arange(60, dtype=np.int32)[:, None], 60, True, 0.9, ed.LINES, 1e-4)
    assert later.max() <= linked.max() - 1 and (apart == linked).all()


def test_the_product_and_the_sum_decide_alike():
    x, y = pairs_at(0.9, 64, 24, 4)
    v = np.concatenate([ed.unit(x), ed.unit(y)])
    r, c = np.arange(64), np.arange(64, 128)
    i, j = (a.ravel() for a in np.mgrid[:64, :64])
    many = ed.verified(r, c, i, j, v, 0.9)
    few = np.concatenate([ed.verified(r, c, i[k:k + 8], j[k:k + 8], v, 0.9) for k in range(0, len(i), 8)])
    assert (many == few).all()


@pytest.mark.parametrize("percent", [50, 80, 85, 90, 100])
def test_bands_follow_from_the_threshold(percent):
    from surveyscore.llm.minhash_dedup import banding

    bands, rows = banding(percent)
    assert (1 - (percent / 100) ** rows) ** bands <= 1e-6 and bands * rows <= 320
    assert percent != 85 or (bands, rows) == (24, 5)


def test_recall_of_pairs_at_eighty_percent(spark):
    """Pairs of one similarity, 0.8 exactly: 45 shared shingles and up to 5.6 of either's own."""
    from surveyscore.llm.minhash_dedup import near_duplicates

    rows = []
    for k in range(400):
        words = [f"w{k}x{j}" for j in range(40)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-4] + [f"z{k}y{j}" for j in range(4)]))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect()
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in found) and {r.n_shingles for r in found} == {36}
