"""Distinct counts and percentiles at several levels against brute force in Python."""

import math
import random

import pytest
from conftest import rows

from surveyscore.operators import combine, summaries

LEVELS = {"fine": ("a", "b"), "coarse": ("a",), "all": ()}


def test_distinct_respondents_of_all_levels_and_several_tables(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]), rnd.choice([None, *(f"n{k}" for k in range(300))])) for _ in range(2000)]
    data += [("z", 9, None)] + [("x", 1, "hot")] * 500
    df = spark.createDataFrame(data, "a string, b int, DN string")
    numbers = summaries.number_respondents(df, ("a", "b"))
    assert numbers.count() == numbers.select("respondent").distinct().count() == len({d for _, _, d in data if d})
    halves = [summaries.respondent_bitmaps(spark.createDataFrame(part, df.schema), ("a", "b"), numbers) for part in (data[:1200], data[1200:])]
    got = summaries.distinct_levels(combine.union_all(halves), LEVELS)
    want = []
    for name, keys in LEVELS.items():
        groups = {}
        for a, b, d in data:
            groups.setdefault((a if "a" in keys else None, b if "b" in keys else None), set()).add(d)
        want += [(name, a, b, len(s - {None})) for (a, b), s in groups.items()]
    assert rows(got, "level", "a", "b", "respondents") == sorted(want, key=repr)


def test_ids_of_a_place_are_neighbours(spark):
    df = spark.range(100_000).selectExpr("CAST(id % 50 AS INT) AS a", "CAST(id AS STRING) AS DN")
    numbers = summaries.number_respondents(df, ("a",))
    per_place = summaries.respondent_bitmaps(df, ("a",), numbers).groupBy("a").count().agg({"count": "max"}).first()[0]
    assert per_place <= 3
    assert summaries.distinct_levels(summaries.respondent_bitmaps(df, ("a",), numbers), {"all": ()}).first().respondents == 100_000


def test_no_respondents(spark):
    df = spark.createDataFrame([], "a string, b int, DN string")
    got = summaries.distinct_levels(summaries.respondent_bitmaps(df, ("a", "b"), summaries.number_respondents(df, ("a", "b"))), LEVELS)
    assert rows(got) == [("all", None, None, 0)]


@pytest.mark.parametrize("bins", [2, 256])
def test_percentiles(spark, bins):
    rnd = random.Random(bins)
    wild = [0.0, -0.5, 1e-300, 1e300, -1e300, 5e-324, 1.0, 1.0 + 2**-52, 1e17, 1e17 + 16, -7.25, float("nan"), None]
    data = [(rnd.choice(["x", "y", None]), rnd.choice([1, 2]), rnd.choice(wild) if rnd.random() < 0.4 else rnd.gauss(0, 100)) for _ in range(1500)]
    data += [("hot", 1, 3.5)] * 700 + [("one", 1, 8.0)] + [("none", 1, None)]
    shares = (0, 0.25, 0.5, 0.9, 0.99, 1)
    got = summaries.percentiles(spark.createDataFrame(data, "a string, b int, v double"), "v", LEVELS, shares, bins)
    want = []
    for name, keys in LEVELS.items():
        groups = {}
        for a, b, v in data:
            if v is not None and not math.isnan(v):
                groups.setdefault((a if "a" in keys else None, b if "b" in keys else None), []).append(v)
        for (a, b), vs in groups.items():
            vs.sort()
            want.append((name, a, b, len(vs), *[vs[max(1, math.ceil(s * len(vs))) - 1] for s in shares]))
    assert got.columns == ["level", "a", "b", "n", "p0", "p25", "p50", "p90", "p99", "p100"]
    assert rows(got) == sorted(want, key=repr)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([("x", 1, None)], "a string, b int, v double")
    assert summaries.percentiles(df, "v", LEVELS, (0.5,)).count() == 0
