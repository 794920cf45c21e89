import datetime
import re

import pytest
from conftest import calls, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyscore import Branch, Registry, Spelling, StateRoundSpec, build_round, build_rounds, run
from surveyscore.operators.decode import Arm, Codebook, Recode
from surveyscore.plans import rounds
from surveyscore.plans.rounds import build_by_branch
from surveyscore.plans.spec import BRANCH_TABLE, branch_rows, moment, read_registry, spec_from_dict
from surveyscore.schema import CANONICAL_COLUMNS, WIDE_LAYOUT

SPELL = Spelling(5, {"A": "A", "B": "B", "O": "O"})


def spec(*branches, state="AP", round="EP", **more):
    return StateRoundSpec(state, round, branches, **more)


def test_latest_round(spark):
    raw = calls(spark, [
        {"DN": "1", "Start_Time": 1, "DTMF_REP": "5"}, {"DN": "1", "Start_Time": 2, "DTMF_REP": ",,"},
        {"DN": "2", "Start_Time": 1, "DTMF_REP": "6,5"}, {"DN": "3", "Start_Time": 1, "DTMF_REP": "5", "Campaign_Name": "AP-BC"},
    ])
    out = build_round(raw, spec(Branch("a", ("AP-EP%",), spelling=SPELL), date_only=True))
    assert out.columns == CANONICAL_COLUMNS
    assert rows(out, "DN", "RES1", "RES2", "AC_ID", "PC_ID") == [("2", "B", "", "AP-AC-1", "AP-1")]


def test_call_in_several_branches_is_emitted_for_each(spark):
    raw = calls(spark, [{"DN": "5", "Start_Time": 1, "DTMF_REP": "5"}, {"DN": "5", "Start_Time": 3, "DTMF_REP": "6"}])
    branches = (Branch("a", ("AP-EP%",), end="2024-01-02", spelling=SPELL), Branch("b", ("AP-EP%",), spelling=SPELL))
    assert rows(build_round(raw, spec(*branches)), "RES1") == [("A",), ("B",)]
    once = build_round(raw, spec(*branches, dedup_after_union=True))
    assert rows(once, "RES1") == [("B",)]


def test_dedup_after_union_stays_within_its_state(spark):
    raw = calls(spark, [
        {"DN": "5", "Start_Time": 1, "DTMF_REP": "5"},
        {"DN": "5", "Start_Time": 2, "DTMF_REP": "6", "Campaign_Name": "BR-EP-PC1"},
    ])
    specs = [spec(Branch("a", ("AP-EP%",), spelling=SPELL), dedup_after_union=True),
             spec(Branch("b", ("BR-EP%",), spelling=SPELL), state="BR", dedup_after_union=True)]
    assert rows(build_round(raw, specs), "RES1") == [("A",), ("B",)]


def test_numbers_of_a_hidden_branch_are_excluded(spark):
    raw = calls(spark, [
        {"DN": "1", "Start_Time": 1, "DTMF_REP": "5"}, {"DN": "2", "Start_Time": 1, "DTMF_REP": "5"},
        {"DN": "2", "Start_Time": 9, "DTMF_REP": "6"}, {"DN": "3", "Start_Time": 9, "DTMF_REP": ",,"},
        {"DN": "3", "Start_Time": 1, "DTMF_REP": "5"}, {"Start_Time": 9, "DTMF_REP": "5"},
        {"Start_Time": 1, "DTMF_REP": "6"},
    ])
    out = build_round(raw, spec(
        Branch("late", ("AP-EP%",), start="2024-01-05", spelling=SPELL, emit=False),
        Branch("early", ("AP-EP%",), end="2024-01-05", spelling=SPELL, exclude_numbers_of="late"),
    ))
    # number 3 was not decoded in the hidden branch; an unknown number excludes nothing
    assert rows(out, "DN", "RES1") == [("1", "A"), ("3", "A"), (None, "B")]


def test_collapse_round_with_vendor_geo_and_recode(spark):
    raw = calls(spark, [
        {"DN": "1", "DTMF_REP": "5,6", "VENDOR_ID": 1, "Start_Time": 1, "Q2_Type": "LSE_2019"},
        {"DN": "2", "DTMF_REP": "5", "VENDOR_ID": 9, "Start_Time": 1, "Q2_Type": "LSE_2019"},
        {"DN": "3", "DTMF_REP": "6", "VENDOR_ID": 1, "Start_Time": 1, "AC_NO": 99, "Q2_Type": "LSE_2019"},
        {"DN": "4", "DTMF_REP": "6", "VENDOR_ID": 1, "Start_Time": 1, "Q2_Type": "LSE_2019"},
        {"DN": "5", "DTMF_REP": ",,", "VENDOR_ID": 1, "Start_Time": 1, "Q2_Type": "LSE_2019"},
    ], Campaign_Name="AP-BC-PC1")
    book = Codebook().add("b", SPELL.arms(["ABO"])).add("b", [Arm(2, "ABO", "6", "later")])
    b = Branch("v", ("AP-BC-PC%",), state_prefix="andh%", q2_type="LSE_2019", dedup="colmax", ordering="vendor",
               vendors={"ABO": (1,)}, book="b", later_keys=True, geo="semi", geo_state="AP",
               recode=(Recode(("AP-1",), ("B",), "UNION"),))
    geo = spark.createDataFrame([("AP", 1), ("AP", 1), ("BR", 99)], "State_Code string, AC_NO int")
    out = build_round(raw, spec(b, round="BC"), book, geo)
    assert rows(out, "DN", "N_PARTY", "RES1", "RES2") == [("1", "ABO", "A", "later"), ("4", "ABO", "UNION", None)]
    with pytest.raises(ValueError):
        build_round(raw, spec(b, round="BC"), book)


def test_post_filter_that_contradicts_its_branch_yields_nothing(spark):
    raw = calls(spark, [{"DN": "1", "PC_NO": 37, "DTMF_REP": "5", "Start_Time": 1}])
    b = Branch("x", ("AP-EP%",), pc_in=(37,), post_pc_in=(79, 80), spelling=SPELL)
    assert build_round(raw, spec(b)).count() == 0


def test_one_scan_equals_scan_per_branch(spark):
    from workload import adapter as A

    sf = "/root/testdata/sf0.001"
    reg = A.registry()
    args = (A.raw_calls(spark, sf), reg.select(reg.keys()), reg.books, A.geo(spark, sf), A.geo_remap(spark, sf))
    assert rows(build_round(*args)) == rows(build_by_branch(*args))


def test_one_scan_per_rule(spark, tmp_path):
    calls(spark, [{"DN": "1", "Start_Time": 1, "DTMF_REP": "5"}]).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    specs = [spec(*(Branch(f"{s}{i}", (f"{s}-EP%",), spelling=SPELL) for i in range(5)), state=s) for s in ("AP", "BR", "CG")]
    plan = build_rounds(raw, specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "StringStartsWith(Campaign_Name,AP-EP)" in plan and "EPIC_NO" not in plan


def test_run_long_and_wide(spark):
    raw = calls(spark, [
        {"DN": str(i), "Start_Time": 1, "DTMF_REP": "5" if i % 3 else "6", "Campaign_Name": f"AP-{r}-PC1"}
        for i in range(9) for r in ("BC", "EP")
    ])
    reg = Registry([spec(Branch(f"{r}1", (f"AP-{r}%",), spelling=SPELL), round=r) for r in ("BC", "EP")])
    region = spark.createDataFrame([("AP", 1, "AP-1", "COAST")], "State_Code string, AC_NO int, PC_ID string, PC_REGION string")
    out = run(raw, reg, ["AP"], ["BC", "EP"], region=region)
    assert out.columns == WIDE_LAYOUT
    got = {(r.ROUND, r.RES1): (r.RES_ACWISE, r.SUMMERY_ACWISE, r.REGION) for r in out.collect()}
    assert got[("BC", "A")] == (6, "A 33.34 (B)", "COAST") and got[("COM", "A")][0] == 12
    wide = run(raw, reg, ["AP"], ["BC", "EP"], form="wide")
    assert wide.first()["EP_RES_ACWISE"] in (3, 6) and wide.first()["PP_RES_ACWISE"] is None


def test_registry():
    reg = Registry([spec(Branch("a", spelling=SPELL))])
    assert [s.key for s in reg.select(["ep_ap"])] == ["ep_ap"]
    with pytest.raises(KeyError):
        reg.select(["ep_ap", "ep_zz"])
    assert [s.key for s in reg.select([" ep_ap ", "ep_zz", 3, None], strict=False)] == ["ep_ap"]
    with pytest.raises(ValueError):
        reg.add(spec(Branch("a", spelling=SPELL), state="BR"))


def test_specs_can_come_from_plain_data():
    data = {"state": "AP", "round": "BC", "branches": [{
        "branch_id": "a", "campaign_like": ["AP-BC%"], "pc_in": [1, 2], "dedup": "colmax", "ordering": "vendor",
        "vendors": {"ABO": [1, "2"]}, "spelling": {"base": 5, "letters": {"A": "x"}},
        "recode": [{"pc_ids": ["AP-1"], "labels": ["x"], "to": "y"}],
    }]}
    s = spec_from_dict(data)
    assert s.key == "bc_ap" and s.branches[0].pc_in == (1, 2) and s.branches[0].recode[0].to == "y"


@pytest.mark.parametrize("bad", [{"dedup": "x"}, {"ordering": "x"}, {"geo": "semi"}, {"spelling": None}])
def test_bad_branches_are_refused(bad):
    with pytest.raises(ValueError):
        Branch("a", **{"spelling": SPELL, **bad})


def test_unpadded_dates_lose_no_call(spark):
    raw = calls(spark, [{"DN": "1", "Start_Time": datetime.datetime(2024, 5, 1), "DTMF_REP": "5"},
                        {"DN": "2", "Start_Time": datetime.datetime(2024, 11, 1), "DTMF_REP": "6"}])
    branches = (Branch("a", ("AP-EP%",), start="2024-4-05", spelling=SPELL), Branch("b", ("AP-EP%",), start="2024-10-01", spelling=SPELL))
    assert rows(build_round(raw, spec(*branches)), "RES1") == rows(build_by_branch(raw, spec(*branches)), "RES1") == [("A",), ("B",), ("B",)]
    for odd in ("soon", "2024-13-01", "2024"):
        with pytest.raises(ValueError):
            Branch("c", start=odd, spelling=SPELL)


def test_moments_sort_as_texts():
    days = ["2024-4-5", "2024-04-05 9:30", "2024-04-05T10:00:00.5", "2024-10-01"]
    assert [moment(d) for d in days] == sorted(moment(d) for d in days)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.booleans(), st.booleans(), st.booleans(), st.sets(st.integers(1, 3))),
                min_size=1, max_size=4))
@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
def test_the_coarse_filter_is_implied_by_the_branches(spark, parts):
    day = lambda n: f"2024-{1 + n // 10}-{1 + n % 10}"
    branches = [Branch(f"b{i}", ("AP-EP%",), start=day(a) if s else None, end=day(b) if e else None, end_inclusive=inc,
                       pc_in=tuple(pcs), q2_type="PM_2024" if inc else "LSE_2019", spelling=SPELL)
                for i, (a, b, s, e, inc, pcs) in enumerate(parts)]
    raw = calls(spark, [{"DN": str(d), "Start_Time": datetime.datetime(2024, 1 + d // 10, 1 + d % 10), "PC_NO": 1 + d % 4,
                         "Q2_Type": "PM_2024" if d % 2 else "LSE_2019"} for d in range(0, 30, 3)])
    coarse = " AND ".join(f"({c})" for c in rounds._coarse_filter(branches, raw)) or "true"
    fits = " OR ".join(f"({rounds.branch_predicate(b, raw)})" for b in branches)
    assert raw.filter(f"({fits}) AND NOT coalesce({coarse}, false)").count() == 0


def test_wide_form_keeps_every_round_and_refuses_a_stray_one(spark):
    raw = calls(spark, [{"DN": str(i), "Start_Time": 1, "DTMF_REP": "5", "Campaign_Name": f"AP-{r}-PC1"} for i, r in enumerate(("EP", "XP"))])
    reg = Registry([spec(Branch(f"b{r}", (f"AP-{r}%",), spelling=SPELL), round=r) for r in ("EP", "XP")])
    long, wide = (run(raw, reg, ["AP"], ["EP", "XP"], form=f) for f in ("long", "wide"))
    keys = ["AC_ID", "PC_ID", "N_PARTY", "RES1"]
    assert rows(long.select(*keys).distinct()) == rows(wide.select(*keys))
    assert {"EP_RES_ACWISE", "XP_RES_ACWISE", "COM_RES_ACWISE"} <= set(wide.columns)
    from surveyscore.operators.combine import combine_rounds_wide

    with pytest.raises(Exception, match="round not listed: XP"):
        combine_rounds_wide(long, ["EP", "COM"]).collect()


def test_plain_text_is_no_list():
    with pytest.raises(ValueError):
        spec_from_dict({"state": "ZZ", "round": "EP", "branches": [{"branch_id": "a", "campaign_like": "ZZ-EP%", "book": "b"}]})
    with pytest.raises(ValueError):
        Branch("a", pc_not_in="12", spelling=SPELL)
    with pytest.raises(ValueError):
        Branch("a", ordering="vendor", vendors={"AB": ()}, spelling=SPELL)
    with pytest.raises(TypeError):
        spec_from_dict({"state": "ZZ", "round": "EP", "branches": [{"branch_id": "a", "colour": 1, "book": "b"}]})


def test_every_branch_field_survives_its_table(spark):
    from pyspark.sql import types as T

    branches = (
        Branch("a", ("AP-BC%", "AP-X%"), ("AP-Z%",), "andhr%", "PM_2024", "2024-1-2", "2024-2-3 4:05", True, (1, 2), (3,), True, "colmax",
               "vendor", {"ABO": (1, 2), "BAO": (3,)}, "book", Spelling(3, {"A": "ALPHA"}), True,
               (Recode(("AP-1",), ("X", "Y"), "Z"),), "remap", "AP", (4,), (5, 6), "2024-1-1", "2025-1-1", "b", False),
        Branch("b", ordering="party", spelling=SPELL),
    )
    specs = [spec(*branches, round="BC", dedup_after_union=True), spec(Branch("c", spelling=SPELL), round="EP", date_only=True)]
    fields = T.StructType.fromDDL(BRANCH_TABLE)
    table = spark.createDataFrame([tuple(r[f.name] for f in fields) for r in branch_rows(specs)], fields)
    back = read_registry(table)
    assert back.select(back.keys()) == specs
    with pytest.raises(TypeError):
        read_registry(table.withColumn("colour", F.lit(1)))


def test_one_scan_for_pools_stacks_and_dense(spark):
    from surveyscore.operators import combine, scoring
    from surveyscore.plans.run import com_of
    from workload import adapter as A

    sf = "/root/testdata/sf0.001"
    resp = A.responses(spark, sf)
    for df in (com_of(resp), scoring.score_scope(resp, "ac", method="dense"), scoring.score_rounds(resp, scopes=("pc",), method="dense"),
               combine.pool_rounds(resp)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"FileScan parquet .*orders", plan)) == 1
