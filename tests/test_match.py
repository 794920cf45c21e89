"""Branches as a table: against the compiled form and against brute force, and with very many of them."""

import random
import re
import time

import pytest
from conftest import calls, rows
from pyspark.sql import functions as F

from surveyscore import Branch
from surveyscore.operators import match
from surveyscore.plans import rounds


def table(spark, data):
    names = [c.split()[0] for c in match.BRANCHES.split(", ")]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], match.BRANCHES)


def some_calls(spark, n=200, seed=1):
    rnd = random.Random(seed)
    names = ["AP-EP-PC1", "AP-EP-PC12-LSE", "TN-BC-PC3-PM", "TN-BC", "A_P%x", "", None, "AP-PP-PC1\\x"]
    return calls(spark, [{"DN": str(i), "Campaign_Name": rnd.choice(names), "PC_NO": rnd.choice([1, 2, None]), "state": rnd.choice(["Andhra", "assam", "TN", None]),
                          "Q2_Type": rnd.choice(["LSE", None]), "Start_Time": rnd.choice([1, 2, 3, None])} for i in range(n)])


def test_equals_the_compiled_branches(spark):
    import datetime

    k = {"book": "x"}
    branches = [Branch("a", ("AP-EP%", "AP%LSE"), state_prefix="a%", **k), Branch("b", ("TN-B_-PC%",), campaign_not_like=("%PM",), **k),
                Branch("c", ("%",), q2_type="LSE", start="2024-01-02", **k), Branch("d", ("%PC1%", "AP%"), pc_in=(1,), end="2024-01-03", **k),
                Branch("e", ("TN-BC",), pc_not_in=(2,), **k), Branch("f", ("",), **k), Branch("g", ("AP-EP-PC1",), **k), Branch("h", ("A\\_P\\%x",), **k)]
    day = lambda d: None if d is None else datetime.datetime.fromisoformat(d)
    listed = table(spark, [{"branch_id": b.branch_id, "campaign_like": list(b.campaign_like), "campaign_not_like": list(b.campaign_not_like) or None,
                            "state_prefix": b.state_prefix, "q2_type": b.q2_type, "start": day(b.start), "end": day(b.end),
                            "pc_in": list(b.pc_in) or None, "pc_not_in": list(b.pc_not_in) or None} for b in branches])
    raw = some_calls(spark)
    numbers = {b.branch_id: k for k, b in enumerate(branches)}
    names = {k: b for b, k in numbers.items()}
    want = sorted((r.DN, names[r["__branch"]]) for r in rounds.tag_branches(raw, branches, numbers).collect())
    assert sorted(rows(match.match_branches(raw, listed), "DN", "branch_id")) == want and len({b for _, b in want}) >= 7


def brute_counts(raw, listed):
    found = match.match_branches(raw, listed).groupBy("branch_id").agg(F.count("*").alias("n_calls"), F.min("DN").alias("first_call"))
    return rows(found, "branch_id", "n_calls", "first_call")


@pytest.mark.parametrize("most", [match.MOST_TIMES, 0])
def test_counts_equal_the_matches(spark, monkeypatch, most):
    import datetime

    monkeypatch.setattr(match, "MOST_TIMES", most)
    rnd, likes = random.Random(5), ["AP-EP%", "AP%LSE", "TN-B_-PC%", "%", "%PC1%", "TN-BC", "", "A\\_P\\%x", None]
    days = [None, None, datetime.datetime(2024, 1, 1, 12), datetime.datetime(2024, 1, 2), datetime.datetime(2024, 1, 3)]
    data = [{"branch_id": rnd.choice(["x", "y", None, f"b{k}"]), "campaign_like": rnd.sample(likes, 2), "campaign_not_like": rnd.choice([None, ["%PM"], ["AP%", None]]),
             "state_prefix": rnd.choice([None, "a%"]), "q2_type": rnd.choice([None, "LSE"]), "start": rnd.choice(days), "end": rnd.choice(days),
             "pc_in": rnd.choice([None, [1], [1, 2]]), "pc_not_in": rnd.choice([None, None, [2], [None, 1]])} for k in range(250)]
    raw, listed = some_calls(spark, 300, 2), table(spark, [*data, *data[:7], {"branch_id": "none"}])
    want = brute_counts(raw, listed)
    assert rows(match.count_branches(raw, listed, "DN"), "branch_id", "n_calls", "first_call") == want and len(want) > 30


def test_counting_makes_no_pairs_of_calls_and_branches(spark, monkeypatch):
    listed = table(spark, [{"branch_id": f"b{k}", "campaign_like": ["AP%"], "q2_type": ["LSE", None][k % 2]} for k in range(3000)])
    raw, pairs, match_branches = some_calls(spark, 2000), [], match.match_branches

    def noted(calls, branches):
        pairs.append(calls.count() * branches.count())
        return match_branches(calls, branches)

    monkeypatch.setattr(match, "match_branches", noted)
    found = match.count_branches(raw, listed, "DN")
    assert found.count() == 3000 and sum(pairs) <= 8
    assert match.count_branches(raw, table(spark, []), "DN").count() == 0


def test_ten_thousand_branches_plan_quickly(spark):
    rnd = random.Random(3)
    data = [{"branch_id": f"b{k}", "campaign_like": [f"S{k % 97:02d}-{k}-PC%", f"S{k % 97:02d}%-{k % 13}"]} for k in range(10_000)]
    names = [f"S{rnd.randint(0, 99):02d}-{rnd.randint(0, 9_999)}-PC{rnd.randint(0, 20)}" + rnd.choice(["", "-5"]) for _ in range(300)]
    raw = calls(spark, [{"DN": str(i), "Campaign_Name": c} for i, c in enumerate(names)])
    listed = table(spark, data)
    started = time.perf_counter()
    found = match.match_branches(raw, listed)
    found._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - started < 20
    tests = [(d["branch_id"], [re.compile(re.escape(p).replace("%", ".*")) for p in d["campaign_like"]]) for d in data]
    want = sorted((str(i), b) for i, c in enumerate(names) for b, ps in tests if any(p.fullmatch(c) for p in ps))
    assert sorted(rows(found, "DN", "branch_id")) == want and len(want) > 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("data", [[], [{"branch_id": "x"}], [{"branch_id": "x", "campaign_like": [None]}]])
def test_without_branches_or_patterns(spark, data):
    assert match.match_branches(some_calls(spark, 5), table(spark, data)).count() == 0


def test_repeated_patterns_and_calls(spark):
    listed = table(spark, [{"branch_id": "x", "campaign_like": ["AP%", "AP%", "AP-EP%"]}] * 2)
    raw = calls(spark, [{"DN": "1", "Campaign_Name": "AP-EP-1"}] * 3)
    assert rows(match.match_branches(raw, listed), "branch_id") == [("x",)] * 6
