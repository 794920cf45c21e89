import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from surveyscore.functions import scalars as fn
from surveyscore.operators import combine, scoring
from surveyscore.schema import SCOPES, WIDE_LAYOUT, STORED_LAYOUT

COLUMNS = "DN string, AC_ID string, PC_ID string, N_PARTY string, RES1 string, AC_NO int, PC_NO int, state string"
METRICS = SCOPES["ac"].columns


def resp(spark, counts, extra=()):
    """Responses of single ACs: {(ac, label): count} plus explicit rows."""
    data = [(f"{ac}{lab}{i}", ac, "P", "ABO", lab, 1, 1, "S") for (ac, lab), n in counts.items() for i in range(n)]
    return spark.createDataFrame(data + list(extra), COLUMNS)


def by_label(df, ac):
    return {r.RES1: tuple(r[m] for m in METRICS) for r in df.collect() if r.AC_ID == ac}


def test_worked_examples(spark):
    df = resp(
        spark,
        {("s1", "A"): 3, ("s1", "B"): 2, ("s1", "C"): 1, ("s2", "A"): 2, ("s2", "B"): 2, ("s3", "A"): 1,
         ("s4", "B"): 1, (None, "A"): 2, (None, "B"): 1},
        extra=[(None, "s4", "P", "ABO", "A", 1, 1, "S")],
    )
    out = scoring.score_scope(df, "ac").cache()
    s1 = by_label(out, "s1")
    assert {k: v[1] for k, v in s1.items()} == {"A": 50.0, "B": 33.33, "C": 16.67}
    assert s1["C"][2:] == (50.0, "A", 33.33, "B", 16.67, "11-20%", "A 16.67 (B)")
    assert by_label(out, "s2")["B"] == (2, 50.0, 50.0, "A", 50.0, "B", 0.0, "0-5%", "A 0.0 (B)")
    assert by_label(out, "s3")["A"] == (1, 100.0, 100.0, "A", None, None, None, "Above 30%", None)
    s4 = by_label(out, "s4")
    assert s4["A"][:2] == (0, 0.0) and s4["B"][1:] == (100.0, 100.0, "B", 0.0, "A", 100.0, "Above 30%", "B 100.0 (A)")
    none = by_label(out, None)
    assert none["A"] == (2, 66.67, 66.67, None, None, None, None, "Above 30%", None)
    assert none["B"][1] == 33.33


def test_draw_is_named_only_on_request(spark):
    df = resp(spark, {("x", "A"): 2, ("x", "B"): 2, ("y", "A"): 2, ("y", "B"): 1})
    draw = scoring.score_scope(df, "ac", on_tie="draw")
    assert by_label(draw, "x")["A"][3] == "DRAW" and by_label(draw, "x")["A"][8] == "DRAW"
    assert by_label(draw, "y")["A"][3] == "A"
    assert rows(scoring.winner(df, "ac")) == [("x", "A"), ("y", "A")]
    with pytest.raises(ValueError):
        scoring.score_scope(df, "ac", on_tie="coin")


def test_no_counted_call_gives_null_percentage(spark):
    df = resp(spark, {}, extra=[(None, "z", "P", "ABO", "A", 1, 1, "S")])
    assert by_label(scoring.score_scope(df, "ac"), "z")["A"][:3] == (0, None, None)


def test_dense_runner_up_lists_ties(spark):
    df = resp(spark, {("x", "A"): 5, ("x", "B"): 2, ("x", "C"): 2, ("x", "D"): 1})
    assert rows(scoring.runner_up(df, "ac", "dense")) == [("x", "B", 20.0), ("x", "C", 20.0)]
    assert rows(scoring.runner_up(df, "ac")) == [("x", "B", 20.0)]
    assert scoring.score_scope(df, "ac", method="dense").count() == 8


def test_margin_bands(spark):
    cases = {0.0: "0-5%", 5.0: "0-5%", 5.01: "6-10%", 10.0: "6-10%", 10.01: "11-20%", 20.0: "11-20%",
             20.01: "21-30%", 30.0: "21-30%", 30.01: "Above 30%", None: "Above 30%", -1.0: "Above 30%"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "m double, want string")
    assert df.filter(fn.margin_bucket("m") != df.want).count() == 0


def test_percentages_are_rounded_half_up_exactly(spark):
    df = spark.range(1, 201).selectExpr("id AS t", "explode(sequence(0L, id)) AS c")
    got = df.select("c", "t", fn.hundredths("c", "t").alias("h")).collect()
    for r in got:
        assert r.h == (20000 * r.c + r.t) // (2 * r.t)


def sample(spark, seed, n=400):
    import random

    rnd = random.Random(seed)
    data = []
    for i in range(n):
        ac = rnd.choice([None, *range(6)])
        data.append((
            None if rnd.random() < 0.05 else str(i), None if ac is None else f"S-AC-{ac}", f"S-{(ac or 0) // 2}",
            rnd.choice(["ABO", "BAO"]), rnd.choice("AAABBCD"), ac, (ac or 0) // 2, rnd.choice(["s", "S"]),
        ))
    return data


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_properties(spark, seed):
    data = sample(spark, seed)
    df = spark.createDataFrame(data, COLUMNS)
    out = scoring.score_all(df).collect()
    keys = [(r.AC_ID, r.PC_ID, r.N_PARTY, r.RES1) for r in out]
    assert len(keys) == len(set(keys)) == len({(d[1], d[2], d[3], d[4]) for d in data})
    for s in SCOPES.values():
        groups = {}
        for r in out:
            groups.setdefault(tuple(r[k] for k in s.keys), {})[r.RES1] = r
        for key, labels in groups.items():
            rs = list(labels.values())
            total = sum(1 for d in data if d[0] is not None and tuple(
                {"AC_ID": d[1], "PC_ID": d[2], "N_PARTY": d[3]}[k] for k in s.keys) == key)
            assert sum(r[s.count] for r in rs) == total
            if total == 0:
                continue
            assert abs(sum(r[s.pct] for r in rs) - 100) <= 0.01 * len(rs)
            assert {r[s.max_pct] for r in rs} == {max(r[s.pct] for r in rs)}
            if None not in key:
                assert labels[rs[0][s.winner]][s.pct] == rs[0][s.max_pct]
                if rs[0][s.second] is not None:
                    assert rs[0][s.max_pct] >= rs[0][s.second]
                    assert rs[0][s.winner] != rs[0][s.runner_up]
    shuffled = spark.createDataFrame(list(reversed(data)), COLUMNS).repartition(7)
    assert rows(scoring.score_all(shuffled)) == sorted((tuple(r) for r in out), key=repr)


def test_one_pass_equals_separate_scopes_and_rounds(spark):
    df = spark.createDataFrame(sample(spark, 7), COLUMNS)
    parts = [scoring.score_scope(df, s) for s in SCOPES]
    assert rows(combine.combine_scopes(parts)) == rows(scoring.score_all(df))

    tagged = df.selectExpr("*", "CASE WHEN DN % 3 = 0 THEN 'BC' WHEN DN % 3 = 1 THEN 'EP' ELSE 'PP' END AS ROUND")
    long = scoring.score_rounds(tagged)
    for r in ("BC", "EP", "PP"):
        one = scoring.score_all(tagged.filter(tagged.ROUND == r)).selectExpr("*", f"'{r}' AS ROUND")
        assert rows(long.filter(long.ROUND == r)) == rows(one)
    assert rows(long.filter("ROUND = 'COM'").drop("ROUND")) == rows(scoring.score_all(df))


def test_layouts():
    assert len(WIDE_LAYOUT) == 45 and len(STORED_LAYOUT) == 27
    assert WIDE_LAYOUT[:8] == ["AC_ID", "PC_ID", "AC_NO", "PC_NO", "state", "N_PARTY", "RES1", "RES_ACWISE"]


def test_hot_constituency_is_counted_before_any_window(spark):
    """Nothing but the grouped count reads raw rows, and it combines before its exchange."""
    df = resp(spark, {("x", "A"): 5, ("y", "B"): 2})
    plan = scoring.score_all(df)._jdf.queryExecution().executedPlan().toString()
    lines = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert len(lines) == 3, plan
    bottom = plan[plan.rindex("Exchange"):]
    assert "partial_count" in bottom and "Window" not in bottom


def test_wide_rounds(spark):
    df = spark.createDataFrame(sample(spark, 3), COLUMNS).selectExpr(
        "*", "CASE WHEN RES1 = 'D' THEN 'PP' WHEN DN % 2 = 0 THEN 'BC' ELSE 'PP' END AS ROUND")
    long = scoring.score_rounds(df, pooled=None, scopes=("ac",))
    every = combine.combine_rounds_wide(long, ["BC", "PP"])
    from_bc = combine.combine_rounds_wide(long, ["BC", "PP"], base="BC")
    assert "D" in {r.RES1 for r in every.collect()} and "D" not in {r.RES1 for r in from_bc.collect()}
    assert from_bc.filter("BC_RES_ACWISE IS NULL").count() == 0
