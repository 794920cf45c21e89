import pytest
from conftest import calls, rows

from surveyscore.operators import decode, filters
from surveyscore.operators.decode import Arm, Codebook, Recode, Spelling

SPELL = Spelling(5, {"A": "A", "B": "B", "O": "O"})
BOOK = Codebook().add("main", SPELL.arms(["ABO"])).add(
    "main", [Arm(2, "ABO", d, lab) for d, lab in (("5", "A"), ("6", "B"), ("8", "O"))])
ANSWERS = {
    "5": ("A", None), "5,6": ("A", "B"), "5,8,6": ("A", "B"), "7,5": (None, "A"), "55": (None, None),
    "5,55": ("A", "A"), "8": ("O", None), "05": (None, None), "": (None, None), ",,": (None, None),
    "5,": ("A", None), ",5": (None, "A"), "x": (None, None), None: (None, None),
}


def answered(spark, answers=tuple(ANSWERS)):
    return calls(spark, [{"DN": str(i), "DTMF_REP": a} for i, a in enumerate(answers)])


def test_first_and_later_keys(spark):
    df = decode.decode_later(decode.decode_first(answered(spark), BOOK), BOOK)
    assert {r.DTMF_REP: (r.RES1, r.RES2) for r in df.collect()} == ANSWERS


def test_stored_book_decodes_alike(spark):
    book = BOOK.to_df(spark)
    df = decode.decode_later(decode.decode_first(answered(spark), book), book)
    assert {r.DTMF_REP: (r.RES1, r.RES2) for r in df.collect()} == ANSWERS


def test_spelling_equals_its_arms(spark):
    df = decode.decode_spelled(answered(spark), SPELL)
    assert {r.DTMF_REP: r.RES1 for r in df.collect()} == {a: v[0] for a, v in ANSWERS.items()}


@pytest.mark.parametrize("code,base,want", [
    ("BIO", 5, {"5": "bjp", "6": "inc", "8": "others"}),
    ("TYIO", 5, {"5": "tdp", "6": "ysr", "7": "inc", "8": "others"}),
    ("BTYIO", 5, {"5": "bjp", "6": "tdp", "7": "ysr", "8": "inc", "9": "others"}),
    ("IBO", 3, {"3": "inc", "4": "bjp", "6": "others"}),
    ("BTYIO", 3, {"3": "bjp", "4": "tdp", "5": "ysr", "6": "inc", "7": "others"}),
])
def test_key_layout(spark, code, base, want):
    s = Spelling(base, {"B": "bjp", "I": "inc", "T": "tdp", "Y": "ysr", "O": "others"})
    assert {a.digit: a.label for a in s.arms([code])} == want
    df = calls(spark, [{"DTMF_REP": str(d)} for d in range(10)], N_PARTY=code)
    got = {r.DTMF_REP: r.RES1 for r in decode.decode_spelled(df, s).collect() if r.RES1}
    assert got == want


def test_forms_and_repeats(spark):
    book = Codebook().add("main", [
        Arm(1, "ABO", "7", "more", "prefix"), Arm(1, "ABO", "8", "only", "exact"),
        Arm(1, "ABO", "5", "first"), Arm(1, "ABO", "5", "second"),
    ])
    df = decode.decode_first(answered(spark, ["7", "7,1", "8", "8,1", "5"]), book)
    assert {r.DTMF_REP: r.RES1 for r in df.collect()} == {"7": None, "7,1": "more", "8": "only", "8,1": None, "5": "first"}
    assert [c[-1] for c in book.conflicts()] == ["second"]
    with pytest.raises(ValueError):
        book.add("main", [Arm(3, "ABO", "5", "x")])


def test_unset_ordering_disappears(spark):
    df = calls(spark, [{"DN": str(v), "VENDOR_ID": v, "DTMF_REP": "5"} for v in (1, 2, 4, None)])
    out = decode.assign_ordering(df, {"ABO": (1, 3), "OTHER": ("4",)})
    assert {r.DN: r.SEQ for r in out.collect()} == {"1": "ABO", "2": "SET_SEQ", "4": "OTHER", "None": "SET_SEQ"}
    kept = filters.drop_undecoded(decode.decode_first(out, BOOK, ordering="SEQ"))
    assert rows(kept, "DN") == [("1",)]


def test_recode_first_rule_wins(spark):
    df = spark.createDataFrame([("S-1", "A"), ("S-1", "C"), ("S-2", "A"), (None, "A")], "PC_ID string, RES1 string")
    rules = [Recode(("S-1",), ("A", "B"), "X"), Recode(("S-1", "S-2"), ("A",), "Y")]
    assert rows(decode.recode(df, rules)) == [("S-1", "C"), ("S-1", "X"), ("S-2", "Y"), (None, "A")]


def test_rule_table_size_is_checked(spark, monkeypatch):
    from surveyscore import rules

    small = BOOK.to_df(spark)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(rules, "MAX_RULE_ROWS", 2)
    assert "Hint" not in BOOK.to_df(spark)._jdf.queryExecution().analyzed().toString()
