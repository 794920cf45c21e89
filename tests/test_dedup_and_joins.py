from conftest import calls, rows

from surveyscore.operators import combine, decode, dedup, enrich, filters
from surveyscore.operators.decode import Codebook, Spelling
from surveyscore.schema import CANONICAL_COLUMNS

BOOK = Codebook().add("main", Spelling(5, {"A": "A", "B": "B", "O": "O"}).arms(["ABO"]))


def test_latest_then_filter_is_not_filter_then_latest(spark):
    df = calls(spark, [
        {"DN": "1", "Start_Time": 1, "DTMF_REP": "5"}, {"DN": "1", "Start_Time": 2, "DTMF_REP": ",,"},
        {"DN": "2", "Start_Time": 1, "DTMF_REP": "5", "AC_NO": 3}, {"DN": "2", "Start_Time": 2, "DTMF_REP": "6"},
    ])
    latest = filters.drop_undecoded(decode.decode_first(dedup.latest_per_key(df), BOOK))
    assert rows(latest, "DN", "DTMF_REP", "AC_NO") == [("2", "6", 1)]
    merged = dedup.collapse_max(filters.valid_answer(df), "DN", ["Start_Time", "DTMF_REP", "AC_NO"])
    got = rows(merged, "DN", "DTMF_REP", "AC_NO")
    assert got == [("1", "5", 1), ("2", "6", 3)]


def test_text_maximum_is_by_text_order(spark):
    df = calls(spark, [{"DN": "3", "DTMF_REP": "10", "Start_Time": 2}, {"DN": "3", "DTMF_REP": "9", "Start_Time": 1}])
    assert rows(dedup.collapse_max(df, "DN", ["DTMF_REP"])) == [("3", "9")]


def test_equal_times_do_not_depend_on_row_order(spark):
    data = [{"DN": "4", "Start_Time": 1, "DTMF_REP": a} for a in ("5", "6", "8")]
    for order in (data, data[::-1]):
        assert rows(dedup.latest_per_key(calls(spark, order)), "DTMF_REP") == [("8",)]


def test_unknown_number_is_one_group(spark):
    df = calls(spark, [{"Start_Time": d, "DTMF_REP": "5"} for d in (1, 2, 3)])
    assert dedup.latest_per_key(df).count() == 1 and dedup.collapse_max(df, "DN", ["AC_NO"]).count() == 1


def test_hot_number_is_cut_before_the_exchange(spark):
    plan = dedup.latest_per_key(calls(spark, [{"DN": "1", "Start_Time": 1}]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    plan = dedup.collapse_max(calls(spark, [{"DN": "1"}]), "DN", ["AC_NO"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max")


def test_geo_check_and_fan_out(spark):
    df = spark.createDataFrame([(1, "S", "a"), (2, "S", "b"), (3, "S", "c"), (None, "S", "d"), (2, "T", "e"), (1, "T", "f")],
                               "AC_NO int, STATE_CODE string, x string")
    geo = spark.createDataFrame([("S", 1), ("S", 1), ("T", 2)], "State_Code string, AC_NO int")
    assert rows(enrich.geo_check(df, geo, ["S"])) == [(1, "S", "a")]
    # the number of one state says nothing of another's
    assert rows(enrich.geo_check(df, geo, ["S", "T"]), "x") == [("a",), ("e",)]
    assert rows(enrich.geo_check(df, geo, ["S"], unique=False)) == [(1, "S", "a"), (1, "S", "a")]


def test_region_keeps_rows_and_does_not_multiply(spark):
    df = spark.createDataFrame([("S-AC-1", "S-1"), ("S-AC-9", "S-1"), (None, None)], "AC_ID string, PC_ID string")
    region = spark.createDataFrame(
        [("S", 1, "S-1", "NORTH"), ("S", 1, "S-1", "EAST")],
        "State_Code string, AC_NO int, PC_ID string, PC_REGION string")
    one = rows(enrich.with_region(df, region), "AC_ID", "REGION")
    assert one == [("S-AC-1", "EAST"), ("S-AC-9", None), (None, None)]
    assert enrich.with_region(df, region, unique=False).count() == 4
    assert rows(enrich.with_region(df, region, ("AC_ID", "PC_ID")), "REGION") == [("EAST",), (None,), (None,)]


def test_large_dimension_is_not_broadcast(spark, monkeypatch):
    from surveyscore import rules

    df = spark.createDataFrame([(1, "S", "a"), (2, "S", "b")], "AC_NO int, STATE_CODE string, x string")
    geo = spark.createDataFrame([("S", 1), ("S", 1), ("T", 2)], "State_Code string, AC_NO int")
    plan = enrich.geo_check(df, geo, ["S"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(rules, "MAX_DIM_ROWS", 0)
    shuffled = enrich.geo_check(df, geo, ["S"])
    assert "strategy=broadcast" not in shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert rows(shuffled) == [(1, "S", "a")]


def test_remap_replaces_constituency(spark):
    df = calls(spark, [{"DN": "1", "AC_NO": 1, "PC_NO": 7}, {"DN": "2", "AC_NO": 5, "PC_NO": 7}])
    remap = spark.createDataFrame([("AP", 1, 12), ("BR", 5, 3)], "State_Code string, AC_NO int, PC_No int")
    out = enrich.geo_remap(filters.derive_ids(df), remap, ["AP", "BR"])
    assert rows(out, "DN", "PC_NO", "PC_ID") == [("1", 12, "AP-12")]


def test_distinct_scores_keeps_a_whole_row(spark):
    df = spark.createDataFrame([("a", "p", "s", "x", "zeta", 1), ("a", "p", "s", "x", "alpha", 9)],
                               "AC_ID string, PC_ID string, N_PARTY string, RES1 string, state string, AC_NO int")
    assert rows(dedup.distinct_scores(df), "state", "AC_NO") == [("alpha", 9)]


def test_rows_without_a_number_are_dealt_out(spark):
    df = spark.range(2000).selectExpr("CAST(NULL AS STRING) AS DN", "id")
    listed = spark.createDataFrame([("2",)], "DN string")
    out = enrich.exclude_numbers(df, listed.hint("merge"))
    assert out.count() == 2000
    key = "coalesce(DN, concat(char(0), CAST(xxhash64(DN, id) AS STRING)))"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [concat(\x00, cast(xxhash64(" in plan and df.selectExpr(f"{key} AS k").distinct().count() == 2000


def test_excluded_list_with_null_removes_nothing_extra(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "DN string")
    listed = spark.createDataFrame([("2",), ("2",), (None,)], "DN string")
    assert rows(enrich.exclude_numbers(df, listed)) == [("1",), (None,)]


def test_combine_on_full_key_does_not_explode(spark):
    base = spark.createDataFrame(
        [("a", "p", "ABO", x, i) for i, x in enumerate("ABC")], "AC_ID string, PC_ID string, N_PARTY string, RES1 string, m1 int")
    other = base.withColumnRenamed("m1", "m2")
    third = base.withColumnRenamed("m1", "m3")
    assert combine.combine_scopes([base, other, third]).count() == 3
    assert combine.join_stored(base, other).columns[-2:] == ["m1", "m2"]


def test_canonical_projection(spark):
    df = filters.derive_ids(calls(spark, [{"DN": "1", "Start_Time": 3, "DTMF_REP": "5"}]))
    out = filters.to_canonical(df.withColumnRenamed("DN", "MOBILE").withColumn("RES1", df.DTMF_REP), date_only=True)
    assert out.columns == CANONICAL_COLUMNS
    row = out.first()
    assert (row.DN, str(row.Start_Time), row.AC_ID, row.PC_ID, row.RES2) == ("1", "2024-01-03", "AP-AC-1", "AP-1", "")


def test_state_name_matches_in_any_case(spark):
    df = spark.createDataFrame([("ASSAM",), ("Assam",), ("Himachal Pradesh",), ("Himachal_Pradesh",)], "state string")
    assert filters.state_prefix(df, "Assa%").count() == 2
    assert filters.state_prefix(df, "HIMACHAL_pradesh%").count() == 2


def test_filters_reach_the_scan(spark, tmp_path):
    calls(spark, [{"DN": "1", "Start_Time": 1, "DTMF_REP": "5"}]).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    out = filters.in_time(filters.pc_in(filters.like(raw, "Campaign_Name", "AP-EP%"), [1]), "2024-01-01").select("DN")
    plan = out._jdf.queryExecution().executedPlan().toString()
    for part in ("StringStartsWith(Campaign_Name,AP-EP)", "EqualTo(PC_NO,1)", "GreaterThanOrEqual(Start_Time"):
        assert part in plan
    assert "EPIC_NO" not in plan
