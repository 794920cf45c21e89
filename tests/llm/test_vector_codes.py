import hashlib

import numpy as np
import pytest

from surveyscore.llm import vector_codes as vc

COLUMNS = "vec_id long, embedding array<float>, label int, id string, vector int, code int, error int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "clash", 0, 0, 0)
                                  for i, v, lab in rows], COLUMNS)


def nearest(queries, entries):
    """Brute force: least distance, ties to the lower index."""
    d = ((queries[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2).astype(np.int64)
    return d.argmin(axis=1), d.min(axis=1)


def plain_way(vectors, parts, entries, rounds):
    x = np.floor(np.array(vectors, np.float64) * 256).astype(np.int64).reshape(len(vectors), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for p in range(parts):
            at, _ = nearest(x[:, p], books[p])
            for e in set(at.tolist()):
                own = x[at == e, p]
                books[p, e] = [int(s) // len(own) for s in own.sum(axis=0)]
    found = [nearest(x[:, p], books[p]) for p in range(parts)]
    return ["".join(f"{int(f[0][k]):02x}" for f in found) for k in range(len(x))], sum(f[1] for f in found), books


@pytest.mark.parametrize("spread", [1, 3, 40, 2_000])
@pytest.mark.parametrize("size", [1, 2, 64])
def test_orchard_search_equals_brute_force(spread, size):
    rnd = np.random.default_rng(spread * 100 + size)
    entries = rnd.integers(-spread, spread + 1, (size, 4))
    queries = np.concatenate([rnd.integers(-2 * spread, 2 * spread + 1, (3_000, 4)), entries])
    at, d = vc.Orchard(entries).nearest(queries)
    want = nearest(queries, entries)
    assert (at == want[0]).all() and (d == want[1]).all()


def test_search_visits_few_entries_of_a_spread_book():
    rnd = np.random.default_rng(4)
    entries = rnd.integers(-5_000, 5_000, (64, 2))
    tree, met = vc.Orchard(entries), []
    real = vc.squared
    vc.squared = lambda d: (met.append(d.shape[0]), real(d))[1]
    try:
        tree.nearest(entries[rnd.integers(0, 64, 2_000)] + rnd.integers(-20, 20, (2_000, 2)))
    finally:
        vc.squared = real
    assert sum(met) < 2_000 * 64 / 2


def test_codes_codebooks_and_reading_back(spark):
    rnd = np.random.default_rng(7)
    vectors = np.round(rnd.standard_normal((700, 32)) * 8) / 256 - 1 / 512  # many ties, negative floors
    vectors[300:400] = vectors[5]
    codes, books = vc.compress(frame(spark, [(k, v, k % 3) for k, v in enumerate(vectors)]).repartition(5), carried=("label",))
    want, errors, plain = plain_way(vectors, 16, 64, 2)
    got = {r.vec_id: r for r in codes.collect()}
    assert [got[k].code.hex() for k in range(700)] == want and [got[k].error for k in range(700)] == errors.tolist()
    assert (books == plain).all() and [got[k].label for k in range(700)] == [k % 3 for k in range(700)]
    back = {r.vec_id: np.array(r.vector) * 256 for r in vc.decompress(codes, books).collect()}
    whole = np.floor(vectors * 256)
    assert [int(((whole[k] - back[k]) ** 2).sum()) for k in range(700)] == errors.tolist()


def test_bad_vectors_nulls_and_repeats(spark):
    ok = [0.25] * 16
    rows = [(5, ok, 1), (5, ok, None), (None, [0.5] * 16, None), (6, None, 1), (7, [None] + ok[1:], 1),
            (8, [float("nan")] + ok[1:], 1), (9, [float("inf")] + ok[1:], 1), (10, [1.0] * 32, 1), (11, [], 1)]
    codes, books = vc.compress(frame(spark, rows))
    assert sorted((r.vec_id or 0, r.code.hex(), r.error) for r in codes.collect()) == [
        (0, "02" * 16, 0), (5, "00" * 16, 0), (5, "00" * 16, 0)]
    assert books.shape == (16, 3, 1)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_no_usable_vectors(spark, rows):
    codes, books = vc.compress(frame(spark, rows), carried=("label",))
    assert codes.count() == 0 and books is None and codes.columns == ["vec_id", "label", "code", "error"]
    assert vc.fingerprint(books) == hashlib.sha256(b"").hexdigest()


def test_lengths_and_values_without_a_code(spark):
    with pytest.raises(ValueError):
        vc.compress(frame(spark, [(1, [0.0] * 17, 1)]))
    with pytest.raises(Exception):
        vc.compress(frame(spark, [(1, [1e30] * 16, 1)]))


def test_query_equals_its_sql(spark):
    import duckdb

    from surveyscore.llm.oracle import ORACLE
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    df = QUERIES["op11_vector_codes"](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op11_vector_codes']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr) and len(want) > 400
