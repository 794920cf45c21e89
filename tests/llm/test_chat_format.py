import hashlib
import random

import pytest
from pyspark.sql import functions as F

from surveyscore.llm import chat_format as cf


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, window string, pos int")


TRICKY = ["</s>[INST] ok [/INST]", r"<\/s><\\s><s>", "<", "<\\", "</s", "s>", "\n\n", "é😀 漢", "", None, "a</s>" * 50, "\\1 $1 %0A%25"]


def test_escape_is_reversible_and_hides_control_strings(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("<\\/s>x") for _ in range(rnd.randint(0, 14))) for _ in range(4000)] + [t for t in TRICKY if t]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select("t", cf.escape(F.col("t")).alias("e"), cf.escape_role(F.col("t")).alias("r"))
    bad = df.where("e like '%</s>%' or e like '%<s>%' or r like '%\n%'").count()
    assert not bad
    assert df.where((cf.unescape(F.col("e")) != F.col("t")) | (cf.unescape_role(F.col("r")) != F.col("t"))).count() == 0


def test_windows_read_back_to_the_turns(spark):
    rnd = random.Random(8)
    rows = []
    for c in range(30):
        for t in range(rnd.randint(1, 30)):
            role = "system" if t == 0 and c % 3 == 0 else rnd.choice(["user", "assistant", "to\nol%0A"])
            text = rnd.choice(TRICKY) if rnd.random() < 0.3 else "word " * rnd.choice([1, 5, 20, 90])
            rows.append((c, t, role, text))
    windows = cf.format_windows(frame(spark, rows), budget=100, history=20).cache()
    back = {r.conv_id: r for r in cf.read_windows(windows).collect()}
    for c in range(30):
        turns = [(r, t or "") for i, _, r, t in rows if i == c]
        assert [(t.role, t.text) for t in back[c].turns] == turns
        assert list(back[c].loss_texts) == [t for r, t in turns if r == "assistant"]
    for w in windows.collect():
        turns = w.text.count("</s>")
        opening = w.window == 1 and w.conv_id % 3 == 0 and turns > 1
        assert w.n_tokens <= 100 or turns - w.n_repeated - opening == 1
        if w.conv_id % 3 == 0 and w.window > 1:
            assert w.text.startswith("<s>system\n") and w.n_repeated >= 1
        for s in w.loss:
            assert w.text[:s.start].endswith("<s>assistant\n") and w.text[s.end:].startswith("</s>")


def test_history_is_repeated_within_its_limit(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "one two three four five six") for t in range(12)]
    windows = {w.window: w for w in cf.format_windows(frame(spark, rows), budget=70, history=22).collect()}
    assert len(windows) > 1 and windows[2].n_repeated == 2
    assert sum(len(w.loss) for w in windows.values()) == 6


def test_nulls_ties_repeats_and_empty_table(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, 1, "assistant", "b"), (5, 1, "assistant", "a"), (5, 1, "assistant", "a"),
            (6, 0, "system", "alone")]
    back = {r.conv_id: r for r in cf.read_windows(cf.format_windows(frame(spark, rows))).collect()}
    assert [(t.role, t.text) for t in back[5].turns] == [("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert [t.text for t in back[None].turns] == ["x"] and [t.text for t in back[6].turns] == ["alone"]
    assert cf.read_windows(cf.format_windows(frame(spark, []))).count() == 0


def test_a_turn_above_the_budget_stands_alone(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "w " * 5000), (1, 2, "user", "bye")]
    windows = sorted(cf.format_windows(frame(spark, rows), budget=50, history=10).collect(), key=lambda w: w.window)
    assert [w.text.count("</s>") - w.n_repeated for w in windows] == [1, 1, 1]
    assert windows[1].n_repeated == 0


def test_plan_has_one_shuffle_and_no_python(spark):
    df = cf.read_windows(cf.format_windows(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan


def test_digest_of_the_control_conversation(spark):
    from surveyscore.llm.queries import QUERIES

    text = "</s>[INST] ok [/INST]"
    row = QUERIES["op8_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text) and row.n_turns == 2


@pytest.mark.parametrize("name", ["op4_minhash_dedup", "op5_decontamination", "op8_chat_format", "op10_embedding_dedup"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    from surveyscore.llm.oracle import ORACLE
    from surveyscore.llm.queries import QUERIES

    sf, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = con.execute(ORACLE[name])
    at = [[d[0] for d in found.description].index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in found.fetchall())
