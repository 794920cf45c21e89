"""Bucketed responses, comparison of runs, and streams of files."""

import datetime as dt
import os
import random
import re
import sys
from collections import Counter

import pytest
from conftest import rows

from surveyscore import Branch, Registry, Spelling, StateRoundSpec
from surveyscore.operators import scoring
from surveyscore.plans import compare, incremental, rounds
from surveyscore.sources import bucketed, sinks
from surveyscore.streaming import events as stream
sys.path.insert(0, os.path.dirname(__file__))
from test_incremental import registry, some_calls


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_passes_over_stored_numbers_have_no_exchange(spark):
    reg, raw = registry(), sinks.materialise(some_calls(spark, 150, 4, hot=50), "raw")
    specs = reg.select(reg.keys())
    found = rounds.build_rounds(raw, specs, reg.books, by_number=True)
    assert "Exchange hashpartitioning" not in plan_of(found) and plan_of(found).count("Window") >= 2
    assert "Exchange hashpartitioning" in plan_of(rounds.build_rounds(raw, specs, reg.books))
    assert rows(scoring.score_rounds(found)) == rows(scoring.score_rounds(rounds.build_rounds(raw, specs, reg.books)))


def test_joins_of_stored_numbers_have_no_exchange(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "DN string, x int")
    right = spark.createDataFrame([("a", 10), (None, 11), ("c", 12)], "DN string, y int")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = bucketed.store_by_number(left, buckets=4).join(bucketed.store_by_number(right, buckets=4), "DN")
        assert "Exchange" not in plan_of(joined) and rows(joined) == [("a", 1, 10), ("a", 4, 10)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bucketed.store_by_number(left.limit(0), buckets=4).count() == 0


def test_named_tables_are_replaced_and_dropped(spark):
    df = spark.createDataFrame([("a", 1)], "DN string, x int")
    path = sinks.fresh_folder(spark, "named")
    for k in (1, 2):
        bucketed.store_by_number(df.withColumn("x", df["x"] * k), "named_calls", path, buckets=2)
    assert rows(spark.table("named_calls")) == [("a", 2)]
    assert rows(bucketed.latest_of_number(spark.table("named_calls"), [], order="x")) == [("a", 2)]
    bucketed.drop_by_number(spark, "named_calls", path)
    assert not spark.catalog.tableExists("named_calls") and not sinks.folder_exists(spark, path)


def score(spark, data):
    return spark.createDataFrame(data, "AC_ID string, PC_ID string, N_PARTY string, RES1 string, ROUND string, state string, votes int")


def row(ac, votes, rnd="BC", state="x", res="A"):
    return (ac, "p", "AB", res, rnd, state, votes)


def test_runs_differ_by_rows_and_multiplicity(spark):
    same = [row("1", 5, "EP"), row(None, None, "EP"), row("1", 5, "EP")]
    old = [row("1", 1), row("2", 2), row("2", 2), row(None, None), row("4", 4, state="y"), *same]
    new = [row("1", 9), row("2", 2), row(None, None), row(None, None), row("5", 5, state="z"), *same]
    a, b = sinks.fresh_folder(spark, "run"), sinks.fresh_folder(spark, "run")
    compare.save_run(score(spark, old), a)
    compare.save_run(score(spark, new), b)
    assert compare.changed_parts(spark, a, b) == [("BC", "x"), ("BC", "y"), ("BC", "z")]
    got = {(r.AC_ID, r.votes): (r.n, r.change) for r in compare.compare_runs(spark, a, b).collect()}
    assert got == {("1", 1): (-1, "changed"), ("1", 9): (1, "changed"), ("2", 2): (-1, "removed"), (None, None): (1, "added"),
                   ("4", 4): (-1, "removed"), ("5", 5): (1, "added")}
    plan = plan_of(compare.compare_runs(spark, a, b))
    assert "ROUND" in re.search(r"PartitionFilters: \[[^\n]*", plan)[0]
    assert compare.compare_runs(spark, a, a).count() == 0


def test_digests_tell_multiplicity_nulls_and_columns(spark):
    def digest(data):
        return rows(compare.part_digests(score(spark, data)))

    assert digest([row("1", 1), row("2", 2)]) == digest([row("2", 2), row("1", 1)])
    assert digest([row("1", 1)] * 2) != digest([row("2", 2)] * 2) and digest([row("1", None)]) != digest([row("1", 42)])
    with pytest.raises(ValueError):
        compare.bag_difference(score(spark, []), score(spark, []).drop("votes"))
    with pytest.raises(ValueError):
        compare.changed_parts(spark, "/nowhere", "/nowhere")
    assert compare.bag_difference(score(spark, []), score(spark, [])).count() == 0


def test_bag_difference_of_random_tables(spark):
    rnd = random.Random(4)
    bags = [[row(rnd.choice(["1", "2", None]), rnd.choice([1, None])) for _ in range(60)] + [row("hot", 1)] * n for n in (300, 200)]
    one, two = map(Counter, bags)
    want = sorted(((*k, two[k] - one[k]) for k in one.keys() | two.keys() if two[k] != one[k]), key=repr)
    assert rows(compare.bag_difference(score(spark, bags[0]), score(spark, bags[1]))) == want


EVENTS = "event_id long, ts timestamp, event_type string, value double"


def write_events(spark, folder, data):
    day = dt.datetime(2024, 1, 1)
    made = [(i, None if d is None else day + dt.timedelta(days=d), k, v) for i, d, k, v in data]
    spark.createDataFrame(made, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_windows_of_files_out_of_order_late_and_repeated(spark):
    folder, target = sinks.fresh_folder(spark, "in"), sinks.fresh_folder(spark, "out")
    schema = spark.createDataFrame([], EVENTS).schema
    write_events(spark, folder, [(1, 10.2, "a", 1.0), (2, 9.0, "a", 2.0), (3, 10.4, "b", 3.0), (4, None, "a", 9.0)])
    first = stream.count_windows(spark, folder, schema, target, delay="5 days", files_per_batch=1)
    assert first.rows == 4 and first.late == 0
    write_events(spark, folder, [(5, 10.9, "a", 4.0), (1, 10.2, "a", 1.0), (6, 7.0, "a", 5.0)])  # one copy; one late, but within the delay
    assert stream.count_windows(spark, folder, schema, target, delay="5 days", files_per_batch=1).late == 0
    write_events(spark, folder, [(7, 30.0, "a", 6.0), (8, 30.0, "a", None)])
    write_events(spark, folder, [(9, 1.0, "a", 7.0), (10, 26.0, "c", 8.0)])  # 9 is behind the watermark by now
    third = stream.count_windows(spark, folder, schema, target, delay="5 days", files_per_batch=1)
    assert (third.rows, third.late) == (4, 1)
    got = {((r.window_start - dt.datetime(2024, 1, 1)).days, r.event_type): (r.n, r.total) for r in stream.read_windows(spark, target).collect()}
    assert got == {(10, "a"): (2, 5.0), (9, "a"): (1, 2.0), (10, "b"): (1, 3.0), (7, "a"): (1, 5.0), (30, "a"): (2, 6.0), (26, "c"): (1, 8.0)}
    assert stream.count_windows(spark, folder, schema, target, delay="5 days").rows == 0


def test_calls_of_a_stream_are_never_too_late(spark):
    spell = Spelling(1, {"A": "ALPHA", "B": "BRAVO", "O": "OTHERS"})
    reg = Registry()
    reg.add(StateRoundSpec("AP", "EP", (Branch("AP_a", ("AP-EP%",), spelling=spell),)))
    specs, raw = reg.select(reg.keys()), sinks.materialise(some_calls(spark, 60, 8), "raw")
    folder, store = sinks.fresh_folder(spark, "in"), sinks.fresh_folder(spark, "store")
    for k in (2, 0, 1):
        raw.where(f"CALL_ID % 3 = {k}").coalesce(1).write.mode("append").parquet(folder)
    done = stream.stream_calls(spark, folder, raw.schema, store, specs, files_per_batch=1)
    assert done.rows == 60 and done.batches == 3
    assert rows(incremental.stored_scores(spark, store)) == rows(scoring.score_rounds(rounds.build_rounds(raw, specs, reg.books)))
