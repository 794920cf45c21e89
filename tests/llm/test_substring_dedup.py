import random
import re

import numpy as np
import pytest

from surveyscore.llm import substring_dedup as sd

COLUMNS = "doc_id long, text string, id string, doc int, version int, place int, at int, h int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0, 0, 0, 0, 0) for i, t in rows], COLUMNS)


def plain_way(rows):
    """Words removed from each row, by brute force; rows of one id are judged by (id, start)."""
    split = [(-2**63 if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in split:
        gone = {p for s in range(len(w) - 19) if first[tuple(w[s:s + 20])] < (i, s) for p in range(s, s + 20)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def agree(spark, rows, parts=3):
    got = sd.remove_repeats(frame(spark, rows).repartition(parts)).collect()
    want = sorted(repr((i, *p)) for (i, _), p in zip(rows, plain_way(rows)))
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in got) == want
    return got


def text(rnd, n, names=5_000):
    return [f"w{rnd.randint(0, names)}" for _ in range(n)]


def test_passages_copies_and_borders(spark):
    rnd = random.Random(1)
    shared = [text(rnd, n) for n in (19, 20, 21, 27, 40, 300)]
    rows = []
    for i in range(120):
        w = text(rnd, rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p) - 15)
            w += p[a:a + rnd.randint(15, 60)] + text(rnd, rnd.randint(0, 5))
        rows.append((i, "  ".join(w) + "\n"))
    rows += [(500 + k, rows[7][1]) for k in range(5)] + [(700, rows[8][1].replace("  ", "\n\t "))]
    got = agree(spark, rows)
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("names", [0, 1, 3, 20])
def test_few_words_make_hot_anchors(spark, names):
    rnd = random.Random(names)
    agree(spark, [(i, " ".join(text(rnd, rnd.randint(0, 150), names))) for i in range(60)])


def test_nulls_empty_repeats_and_shared_ids(spark):
    w = [f"a{k}" for k in range(60)]
    long = " ".join(w)
    agree(spark, [(None, long), (None, None), (1, ""), (2, " \t\n"), (3, " ".join(w[:19])), (4, long), (4, long), (-9, " ".join(w[5:40])),
                  (5, "x " + long), (5, "y z " + long), (6, "\x1f" + long + "\x0b\x0c é漢 b"), (2**62, long.upper())])
    assert sd.remove_repeats(frame(spark, [])).count() == 0


def test_a_hot_row_spreads_over_blocks(spark):
    rnd = random.Random(3)
    hot = " ".join(text(rnd, 200))
    rows = [(i, hot if i % 3 == 0 else f"{' '.join(text(rnd, 30))} {hot[:400]} tail{i}") for i in range(300)] + [(3, hot)] * 50
    agree(spark, rows, 7)


def test_very_long_texts_and_small_runs(spark, monkeypatch):
    rnd = random.Random(5)
    w = text(rnd, 3_000)
    rows = [(1, " ".join(w)), (2, "word" * 50_000 + " " + " ".join(w[100:])), (3, " ".join(w[50:2_000] * 3))]
    agree(spark, rows)
    raw = rows[0][1].encode()
    first, stop, starts = sd.words_of(raw, np.array([0, len(raw)]))
    whole = sd.word_hashes(raw, first, stop)
    monkeypatch.setattr(sd, "BYTES", 1_000)
    assert (sd.word_hashes(raw, first, stop) == whole).all()
    windows = [s for low, high in sd.word_runs(np.diff(starts)) for b, n, *_ in [sd.phrases(whole[low:high], np.zeros(high - low, int))]
               for a, k in zip(b.tolist(), n.tolist()) for s in range(low + a, low + a + k)]
    assert windows == list(range(3_000 - 19))


def test_blocks_in_batches_of_any_size():
    rnd = np.random.default_rng(2)
    rows = rnd.integers(0, 4, (4, 600))
    rows[3] = sd.place(rows[3], rnd.integers(0, 2, 600), 1)
    rows = rows[:, np.lexsort(rows[::-1])]
    wanted = None
    for size in (600, 1, 7):
        state = sd.Groups()
        out = [x for k in range(0, 600, size) for x in state.batch(rows[:, k:k + size])] + list(state.end())
        flat = {(kind, *r, ref[2], sd.start_of(ref[3])) for kind, a, b in out for r, ref in zip(a.T.tolist(), b.T.tolist())}
        wanted = wanted or flat
        assert flat == wanted and {f[0] for f in flat} == {0, 1, 2}


def test_factors_name_an_earlier_place(spark):
    rnd = random.Random(8)
    p = text(rnd, 90)
    texts = {1: text(rnd, 30) + p, 2: p[10:70] + text(rnd, 40), 3: text(rnd, 5) + p[20:] + p[:40]}
    for r in sd.remove_repeats(frame(spark, [(k, " ".join(v)) for k, v in texts.items()])).collect():
        for f in r.factors:
            n = f.end - f.start
            assert (f.ref_id, f.ref_start) < (r.doc_id, f.start) and n >= 20
            assert texts[f.ref_id][f.ref_start:f.ref_start + n] == texts[r.doc_id][f.start:f.end]
        if r.doc_id == 2:
            assert [(f.start, f.end, f.ref_id, f.ref_start) for f in r.factors] == [(0, 60, 1, 40)]


def test_query_equals_its_sql(spark):
    import duckdb

    from surveyscore.llm.oracle import ORACLE
    from surveyscore.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES["op12_substring_dedup"](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op12_substring_dedup']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr) and len(want) > 900
    assert sum(r[2] for r in want) > 0
