import re

import pytest
from conftest import calls, rows

from surveyscore import build_round, build_rounds, run
from surveyscore.plans import presets


def decoded(spark, reg, key, data, **fixed):
    out = build_round(calls(spark, data, **fixed), reg.select([key]), reg.books)
    return {r.DN: (r.RES1, r.RES2) for r in out.collect()}


def one_call(code, answer, i, **more):
    return {"DN": f"{code}/{answer}", "N_PARTY": code, "DTMF_REP": answer, "Start_Time": 20, **more}


def labels(spark, reg, key, pairs, **fixed):
    got = decoded(spark, reg, key, [one_call(c, a, i) for i, (c, a) in enumerate(pairs)], **fixed)
    return [got.get(f"{c}/{a}", (None,))[0] for c, a in pairs]


def test_every_state_has_both_rounds():
    ep, pp = presets.ep_registry(open_codes=True), presets.pp_registry(open_codes=True)
    assert len(ep.keys()) == len(pp.keys()) == 23
    assert ep.keys() == [f"ep_{s}" for s in presets.STATES]
    assert sum(len(s.branches) for s in ep.select(ep.keys())) == 28
    assert sum(len(s.branches) for s in pp.select(pp.keys())) == 38
    merged = presets.merge(ep, pp)
    assert len(merged.rounds(["ap", "wb"], ["EP", "PP"])) == 4


def test_ep_labels(spark):
    ep = presets.ep_registry(open_codes=True)
    got = labels(spark, ep, "ep_ap", [("TYIO", "5"), ("YBMO", "7,1"), ("YTCO", "8"), ("TYIO", "9"), ("TYIO", "55")])
    assert got == ["TDP+", "CPIM", "OTHERS", None, None]
    got = labels(spark, ep, "ep_ch", [("IBO", "3"), ("IBO", "6"), ("IBO", "5")], Campaign_Name="CH-EP-1")
    assert got == ["INC", "OTHERS", None]
    got = labels(spark, ep, "ep_jh", [("JANO", "6"), ("JAO", "6"), ("JAO", "8")], Campaign_Name="JH-EP-1")
    assert got == ["AJSU", "AJSUP", "OTHERS"]
    got = labels(spark, ep, "ep_br", [("BRMNZ", "9"), ("JVMAO", "8")], Campaign_Name="BR-EP-1")
    assert got == ["IND2", "AIMIM"]


def test_key_layout_changes_with_the_date(spark):
    import datetime

    ep = presets.ep_registry(open_codes=True)
    may, june = datetime.datetime(2024, 5, 1), datetime.datetime(2024, 6, 2)
    got = decoded(spark, ep, "ep_wb", [
        {"DN": "1", "N_PARTY": "ABRO", "DTMF_REP": "8", "Start_Time": may},
        {"DN": "2", "N_PARTY": "ABRO", "DTMF_REP": "8", "Start_Time": june},
        {"DN": "3", "N_PARTY": "ABRO", "DTMF_REP": "7", "Start_Time": june},
        {"DN": "4", "N_PARTY": "BAIO", "DTMF_REP": "9", "Start_Time": may},
        {"DN": "5", "N_PARTY": "BAIO", "DTMF_REP": "8", "Start_Time": may},
    ], Campaign_Name="WB-EP-1")
    assert got == {"1": ("RSP", ""), "3": ("RSP", ""), "4": ("OTHERS", "")}
    got = decoded(spark, ep, "ep_od", [
        {"DN": "1", "N_PARTY": "BDIO", "DTMF_REP": "6", "Start_Time": may},
        {"DN": "1", "N_PARTY": "BDIO", "DTMF_REP": "3", "Start_Time": june},
        {"DN": "2", "N_PARTY": "BDIO", "DTMF_REP": "6", "Start_Time": june},
    ], Campaign_Name="OD-EP-1")
    assert got == {"1": ("BJP", ""), "2": ("OTHERS", "")}


def test_pp_labels(spark):
    import datetime

    pp = presets.pp_registry(open_codes=True)
    april = datetime.datetime(2024, 4, 20)
    got = decoded(spark, pp, "pp_pb", [
        {"DN": "1", "N_PARTY": "ABISMO", "DTMF_REP": "0"}, {"DN": "2", "N_PARTY": "ABISMO", "DTMF_REP": "9"},
    ], Campaign_Name="PB-AC-3", Start_Time=april)
    assert got == {"1": ("OTHERS", ""), "2": ("BSP", "")}
    got = decoded(spark, pp, "pp_wb", [
        {"DN": "1", "N_PARTY": "ABIO", "DTMF_REP": "7,1"}, {"DN": "2", "N_PARTY": "ABIO", "DTMF_REP": "7"},
        {"DN": "3", "N_PARTY": "ABIO", "DTMF_REP": "8"},
    ], Campaign_Name="WB-PP-3", state="WEST BENGAL", Start_Time=april)
    assert got == {"1": ("INC", ""), "3": ("INC", "")}
    got = decoded(spark, pp, "pp_rj", [
        {"DN": "1", "N_PARTY": "CBMO", "DTMF_REP": "5,6"}, {"DN": "2", "N_PARTY": "RBMO", "DTMF_REP": "5,6"},
    ], Campaign_Name="RJ-PP-3", state="Rajasthan", Start_Time=april)
    assert got == {"1": ("CPIM", "BJP"), "2": ("RLP", None)}
    got = decoded(spark, pp, "pp_hp", [{"DN": "1", "N_PARTY": "BIO", "DTMF_REP": "5,6"}], Campaign_Name="HP-PP-2", Start_Time=april)
    assert got == {"1": ("BJP", "INC")}
    assert decoded(spark, pp, "pp_hp", [{"DN": "1", "N_PARTY": "BIO", "DTMF_REP": "5"}], Campaign_Name="HP-PP-AC2", Start_Time=april) == {}


def test_listed_numbers_are_excluded(spark):
    import datetime

    pp = presets.pp_registry(open_codes=True)
    march, april = datetime.datetime(2024, 3, 25), datetime.datetime(2024, 4, 20)
    got = build_round(calls(spark, [
        {"DN": "1", "VENDOR_ID": 2, "DTMF_REP": "5", "Start_Time": march},
        {"DN": "2", "VENDOR_ID": 2, "DTMF_REP": "5", "Start_Time": march},
        {"DN": "2", "VENDOR_ID": 2, "DTMF_REP": "5", "N_PARTY": "BDATO", "Start_Time": april},
    ], Campaign_Name="TN-PP-1", state="Tamil Nadu", PC_NO=20), pp.select(["pp_tn"]), pp.books)
    assert rows(got, "DN", "N_PARTY", "RES1") == [("1", "NDABO", "NTK"), ("2", "BDATO", "BJP")]


def test_closed_orderings(spark):
    open_, closed = presets.ep_registry(open_codes=True), presets.ep_registry({"ap": ["TYIO"], "jh": ["JANO", "BIO"]}, open_codes=True)
    pairs = [("TYIO", "5"), ("TBIO", "5")]
    assert labels(spark, open_, "ep_ap", pairs) == ["TDP+", "TDP+"]
    assert labels(spark, closed, "ep_ap", pairs) == ["TDP+", None]
    pairs = [("JANO", "6"), ("BIO", "5"), ("JAO", "6")]
    assert labels(spark, closed, "ep_jh", pairs, Campaign_Name="JH-EP-1") == ["AJSU", "BJP", None]


def test_bc_schedule(spark):
    reg = presets.bc_registry([
        {"state": "ap", "q2_type": "LSE_2019", "pc_in": (1, 8), "vendors": {"BYIO": (1, 3), "YBIO": (4,)},
         "letters": {"T": "TDP"}},
        {"state": "ap", "q2_type": "PM_2024", "pc_in": (1, 8), "vendors": {"TYIO": (1, 3)}, "letters": {"T": "TDP"}},
    ])
    raw = calls(spark, [
        {"DN": "1", "VENDOR_ID": 3, "DTMF_REP": "6", "Q2_Type": "LSE_2019"},
        {"DN": "2", "VENDOR_ID": 3, "DTMF_REP": "5", "Q2_Type": "PM_2024"},
        {"DN": "3", "VENDOR_ID": 5, "DTMF_REP": "5", "Q2_Type": "PM_2024"},
    ], Campaign_Name="AP-BC-PC1", state="ANDHRA PRADESH", Start_Time=1)
    geo = spark.createDataFrame([("AP", 1)], "State_Code string, AC_NO int")
    out = build_round(raw, reg.select(["bc_ap"]), reg.books, geo)
    assert rows(out, "DN", "N_PARTY", "RES1") == [("1", "BYIO", "YSRCP"), ("2", "TYIO", "TDP")]


def test_stored_schedule(spark):
    df = spark.createDataFrame(
        [("b", "ap", "TYIO", "1,3", "PM_2024", "1,8"), ("b", "ap", "YTIO", "4", "PM_2024", "1,8"),
         ("c", "ga", "BIO", "2", None, "")],
        "branch string, state string, ordering string, vendor_ids string, q2_type string, pc_in string")
    entries = presets.read_schedule(df)
    assert entries[0] == {"state": "ap", "q2_type": "PM_2024", "pc_in": (1, 8), "vendors": {"TYIO": (1, 3), "YTIO": (4,)}}
    assert presets.bc_registry(entries).select(["bc_ga"])[0].branches[0].campaign_like == ("GA-BC-PC%",)


def test_all_states_compile_to_few_scans(spark, tmp_path):
    calls(spark, [one_call("TYIO", "5", 0)]).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    reg = presets.merge(presets.ep_registry(open_codes=True), presets.pp_registry(open_codes=True))
    plan = build_rounds(raw, reg.select(reg.keys()), reg.books)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # latest call, column-wise maximum
    scored = run(raw, reg, presets.STATES, ["EP", "PP"])
    assert scored.filter("ROUND = 'COM'").count() == 1
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    read = " ".join(re.findall(r"ReadSchema: (\S+)", plan))
    assert "DTMF_REP" in read and not any(c in read for c in ("GENDER", "CASTE", "AGE", "PART_NO", "EPIC_NO"))


def test_unknown_state_is_refused():
    with pytest.raises(KeyError):
        presets.ep_registry(open_codes=True).rounds(["zz"], ["EP"])


def test_books_are_closed_unless_asked_for():
    with pytest.raises(ValueError):
        presets.ep_registry()
    closed = presets.pp_registry({"ap": ["TYIO"], "pp_dl_0": ["ABO"], "pp_dl_1": ["BAO"], "pp_pb_0": ["ABIO"]})
    # West Bengal's books hold listed arms only; Punjab's other branches have no list
    assert sorted(closed.keys()) == ["pp_ap", "pp_dl", "pp_wb"]
    assert all(b.spelling is None for s in closed.select(closed.keys()) for b in s.branches)
