import hashlib
import random
import re

import numpy as np
import pytest

from surveyscore.llm import fill_in_middle as fim

TEXTS = ["", None, "one", "a\nb\nc\n", "\n", "\n\n\n", "no end\nof line", "é漢😀\nx\r\ny z\n", "has <P> inside\nx", "<S\n<", "P>\n<M",
         "x" * 50_000 + "\n", "line\n" * 30_000, "".join(f"{'w' * (k * k % 977)}\n" for k in range(3_000))]
COLUMNS = "doc_id long, text string, id string, n int, form int, output int, h1 int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0, 0, 0, 0) for i, t in rows], COLUMNS)


def plain_way(doc_id, text, fim_percent=100, spm_percent=50, seed=7):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim_percent:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("share", [(100, 50), (40, 20), (0, 50)])
def test_equals_the_plain_way_and_comes_back(spark, share):
    rows = [(k, t) for k, t in enumerate(TEXTS * 6)] + [(None, "a\nb"), (-5, "c\nd\n"), (3, "r\ns\nt"), (3, "r\ns\nt")]
    made = fim.rearrange(frame(spark, rows), fim_percent=share[0], spm_percent=share[1])
    back = made.withColumn("back", fim.restored(made["output"], made["form"])).collect()
    want = sorted((repr((i, *plain_way(i, t, *share))), t or "") for i, t in rows)
    got = sorted((repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)), r.back) for r in back)
    assert got == want


def test_empty_table_and_text_ids(spark):
    assert fim.rearrange(frame(spark, [])).count() == 0
    named = spark.createDataFrame([("k1", "a\nb\nc")], "doc_id string, text string")
    r = fim.rearrange(named).first()
    assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_way("k1", "a\nb\nc")


def test_the_index_is_exact_and_its_segments_are_bounded():
    rnd = np.random.default_rng(5)
    steps = np.concatenate([rnd.integers(1, 90, 50_000), [900_000], rnd.integers(1, 3_000, 9_000), np.ones(20_000, int), [0, 0]])
    values = np.cumsum(steps)
    index = fim.RankIndex(values)
    assert (index.find(np.arange(len(values))) == values).all()
    assert np.abs(index.residuals.astype(int)).max() <= fim.ERROR + 1 and len(index.first) < len(values) / 100
    assert len(fim.RankIndex(np.zeros(0, np.int64)).first) == 0
    at = rnd.integers(0, len(values), 1000)
    assert (np.abs(index.predict(at) - values[at]) <= fim.ERROR + 1).all()


def test_parts_of_random_texts_come_back(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("<PSM>\nab") for _ in range(rnd.randint(0, 30))) for _ in range(2_000)]
    made = fim.rearrange(frame(spark, enumerate(texts)))
    got = {r.doc_id: r for r in made.withColumn("back", fim.restored(made["output"], made["form"])).collect()}
    assert all(got[k].back == t and got[k].output == plain_way(k, t)[-1] for k, t in enumerate(texts))


def test_query_equals_its_sql(spark):
    import duckdb

    from surveyscore.llm.oracle import ORACLE
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES["op13_fill_in_middle"](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op13_fill_in_middle']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr) and len(want) > 900
