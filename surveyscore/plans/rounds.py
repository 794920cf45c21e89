"""Build canonical responses from raw calls.

All branches of all requested specs are compiled into one scan: each call is tagged with the
branches it belongs to (a call may belong to several, as with UNION ALL) and everything after
is keyed by the branch. ``build_by_branch`` is the plain form, one scan per branch, kept to
check the compiled one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore import schema as S
from surveyscore.functions import scalars as fn
from surveyscore.operators import decode, dedup
from surveyscore.operators.combine import union_all
from surveyscore.operators.decode import Codebook
from surveyscore.plans.spec import Branch, StateRoundSpec
from surveyscore.rules import broadcast_if_small, rule_table
from surveyscore.sources.bucketed import store_by_number

# What the build reads from a raw call. Other respondent details are never scanned.
_USED = [
    "DN", "Start_Time", "DTMF_REP", "state", "AC_NO", "PC_NO", "PART_NO", "GENDER", "AGE",
    "N_PARTY", "PARTY", "VENDOR_ID", "CASTE",
]

BRANCH = "__branch"

_BRANCH_SCHEMA = T.StructType([
    T.StructField(BRANCH, T.IntegerType()),
    T.StructField("branch_id", T.StringType()),
    T.StructField("__spec", T.StringType()),
    T.StructField("__unit", T.StringType()),
    T.StructField("__source", T.IntegerType()),
    T.StructField("ROUND", T.StringType()),
    T.StructField("__ordering", T.StringType()),
    T.StructField("__book", T.StringType()),
    T.StructField("__base", T.IntegerType()),
    T.StructField("__letters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("__geo", T.StringType()),
    T.StructField("__geo_state", T.StringType()),
    T.StructField("__day", T.BooleanType()),
])


def _all(parts: list[str]) -> str:
    return " AND ".join(f"({p})" for p in parts) if parts else "true"


def branch_predicate(b: Branch, raw: DataFrame) -> str:
    """Condition under which a raw call belongs to a branch."""
    parts = []
    if b.campaign_like:
        parts.append(fn.like_any_sql("Campaign_Name", b.campaign_like))
    if b.campaign_not_like:
        parts.append("NOT " + fn.like_any_sql("Campaign_Name", b.campaign_not_like))
    if b.state_prefix:
        parts.append(fn.state_like_sql("state", b.state_prefix))
    if b.q2_type:
        parts.append(f"Q2_Type = {fn.text(b.q2_type)}")
    if b.start or b.end:
        kind = raw.schema["Start_Time"].dataType
        parts.append(fn.time_window_sql("Start_Time", b.start, b.end, b.end_inclusive, kind))
    if b.pc_in:
        parts.append(f"PC_NO IN ({fn.numbers(b.pc_in)})")
    if b.pc_not_in:
        parts.append(f"PC_NO NOT IN ({fn.numbers(b.pc_not_in)})")
    if b.pc_known:
        parts.append("PC_NO IS NOT NULL")
    if b.dedup == "colmax":
        parts.append(fn.valid_answer_sql())
    return _all(parts)


def _literal_prefix(pattern: str) -> str:
    cut = min((i for i in map(pattern.find, ("%", "_", "\\")) if i >= 0), default=len(pattern))
    return pattern[:cut]


def _coarse_filter(branches: list[Branch], raw: DataFrame) -> list[str]:
    """Conditions implied by every branch that the scan can evaluate on its own statistics."""
    out = []
    if all(b.campaign_like for b in branches):
        prefixes = sorted({_literal_prefix(p) for b in branches for p in b.campaign_like})
        short = [p for p in prefixes if not any(p != q and p.startswith(q) for q in prefixes)]
        if all(short):
            out.append(" OR ".join(f"startswith(Campaign_Name, {fn.text(p)})" for p in short))
    kind = raw.schema["Start_Time"].dataType
    if all(b.start for b in branches):
        out.append(fn.time_window_sql("Start_Time", min(b.start for b in branches), dtype=kind))
    if all(b.end for b in branches):
        out.append(fn.time_window_sql("Start_Time", end=max(b.end for b in branches), end_inclusive=True, dtype=kind))
    if all(b.q2_type for b in branches):
        kinds = ", ".join(sorted({fn.text(b.q2_type) for b in branches}))
        out.append(f"Q2_Type IN ({kinds})")
    if all(b.pc_in for b in branches):
        out.append(f"PC_NO IN ({fn.numbers(sorted({n for b in branches for n in b.pc_in}))})")
    if all(b.dedup == "colmax" for b in branches):
        out.append(fn.valid_answer_sql())
    return out


def tag_branches(raw: DataFrame, branches: list[Branch], numbers: Mapping[str, int]) -> DataFrame:
    """One row per (call, branch it belongs to); the branch is a small integer.

    Branches are grouped by the two leading letters of their campaign patterns, so a call is
    tested against the branches of its own state only.
    """
    if len(branches) == 1:
        b = branches[0]
        return raw.filter(branch_predicate(b, raw)).withColumn(BRANCH, F.lit(numbers[b.branch_id]))
    groups = defaultdict(list)
    for b in branches:
        codes = {_literal_prefix(p)[:2] for p in b.campaign_like}
        code = codes.pop() if len(codes) == 1 else ""
        groups[code if len(code) == 2 else None].append(b)

    def hits(group: list[Branch]) -> str:
        tests = [f"CASE WHEN {branch_predicate(b, raw)} THEN {numbers[b.branch_id]} END" for b in group]
        return f"array({', '.join(tests)})"

    arrays = [hits(groups.pop(None))] if None in groups else []
    if groups:
        arms = [f"WHEN {fn.text(prefix)} THEN {hits(group)}" for prefix, group in groups.items()]
        own = f"CASE substring(Campaign_Name, 1, 2) {' '.join(arms)} END"
        arrays.append(f"coalesce({own}, CAST(array() AS ARRAY<INT>))")
    # array_except drops the NULLs of branches that do not match and, unlike a lambda filter,
    # leaves the predicates in generated code.
    found = f"concat({', '.join(arrays)})" if len(arrays) > 1 else arrays[0]
    coarse = _coarse_filter(branches, raw)
    out = raw.filter(_all(coarse)) if coarse else raw
    return out.selectExpr("*", f"explode(array_except({found}, array(CAST(NULL AS INT)))) AS {BRANCH}")


def tagged_calls(raw: DataFrame, branches: list[Branch], numbers: Mapping[str, int], style: str) -> DataFrame:
    """What the build keeps of the calls of the branches that de-duplicate by ``style``."""
    code = "substring(Campaign_Name, 1, 2) AS STATE_CODE"
    extra = ["CALL_ID"] if style == "latest" and "CALL_ID" in raw.columns else []
    return tag_branches(raw, branches, numbers).selectExpr(BRANCH, code, *_USED, *extra)


def collapse(calls: DataFrame, style: str, tie: list[str] | None = None, by: str = BRANCH) -> DataFrame:
    """One row per number and branch. Collapsed rows may be collapsed again with further calls.

    The number comes before the branch in the keys: sorts compare the first key by a binary
    prefix, which tells numbers apart at once but a handful of branches hardly. Equal times are
    settled by the call id, when there is one; otherwise by ``tie``, or all columns.
    """
    if style == "colmax":
        return dedup.collapse_max(calls, ["DN", by])
    return dedup.latest_per_key(calls, ["DN", by], tie=["CALL_ID"] if "CALL_ID" in calls.columns else tie)


def _collapsed(raw: DataFrame, branches: list[Branch], numbers: Mapping[str, int],
               tie: list[str] | None = None) -> DataFrame:
    """Tag and de-duplicate within each branch. Both rules give the same columns."""
    out = []
    for style in ("latest", "colmax"):
        group = [b for b in branches if b.dedup == style]
        if group:
            out.append(collapse(tagged_calls(raw, group, numbers, style), style, tie).drop("CALL_ID"))
    return union_all(out)


def _numbers(specs: list[StateRoundSpec]) -> dict[str, int]:
    return {b.branch_id: i for i, b in enumerate(b for s in specs for b in s.branches)}


def _branch_rows(specs: list[StateRoundSpec]):
    numbers = _numbers(specs)
    for s in specs:
        for b in s.branches:
            source = numbers[b.exclude_numbers_of] if b.exclude_numbers_of else None
            yield (
                numbers[b.branch_id], b.branch_id, s.key,
                # Numbers are unique across the branches of a state only where the spec asks for it.
                None if s.dedup_after_union else b.branch_id, source, s.round, b.ordering, b.book,
                b.spelling.base if b.spelling else None,
                dict(b.spelling.letters) if b.spelling else None, b.geo, b.geo_state, s.date_only,
            )


def _geo_checked(df: DataFrame, branches: list[Branch], geo: DataFrame | None,
                 remap: DataFrame | None) -> DataFrame:
    semi = [b for b in branches if b.geo == "semi"]
    moved = [b for b in branches if b.geo == "remap"]
    here = "__geo_state = __s AND AC_NO = __a"
    if semi:
        if geo is None:
            raise ValueError("these branches check the geography; pass geo=")
        dim = broadcast_if_small(geo.selectExpr("State_Code AS __s", "AC_NO AS __a").distinct())
        if len(semi) == len(branches):
            df = df.join(dim, F.expr(here), "left_semi")
        else:
            df = df.join(dim, F.expr(f"{here} AND __geo = 'semi'"), "left")
            df = df.filter("__s IS NOT NULL OR NOT (__geo <=> 'semi')").drop("__s", "__a")
    if moved:
        if remap is None:
            raise ValueError("these branches take the PC from the geography; pass geo_remap=")
        dim = remap.selectExpr("State_Code AS __s", "AC_NO AS __a", "PC_No AS __pc").distinct()
        dim = broadcast_if_small(dim)
        df = df.join(dim, F.expr(f"{here} AND __geo = 'remap'"), "left")
        df = df.filter("__s IS NOT NULL OR NOT (__geo <=> 'remap')").withColumns({
            "PC_NO": F.expr("CASE WHEN __geo <=> 'remap' THEN __pc ELSE PC_NO END"),
            "PC_ID": F.expr(f"CASE WHEN __geo <=> 'remap' THEN {fn.pc_id_sql('__s', '__pc')} ELSE PC_ID END"),
        }).drop("__s", "__a", "__pc")
    return df


def _post_filter(df: DataFrame, branches: list[Branch], numbers: Mapping[str, int]) -> DataFrame:
    """Conditions that a branch puts on its finished rows."""
    arms = ""
    for b in branches:
        parts = []
        if b.post_pc_in:
            parts.append(f"PC_NO IN ({fn.numbers(b.post_pc_in)})")
        if b.post_pc_not_in:
            parts.append(f"PC_NO NOT IN ({fn.numbers(b.post_pc_not_in)})")
        if b.post_start or b.post_end:
            kind = df.schema["Start_Time"].dataType
            parts.append(fn.time_window_sql("Start_Time", b.post_start, b.post_end, dtype=kind))
        if parts:
            arms += f" WHEN {numbers[b.branch_id]} THEN {_all(parts)}"
    return df.filter(f"CASE {BRANCH}{arms} ELSE true END") if arms else df


def _excluded(df: DataFrame) -> DataFrame:
    """Drop numbers that another branch of the same state has decoded.

    A window over (state, number) sees which branches hold the number: at most one row per
    branch, and no second scan as a self-join would need.
    """
    held = f"collect_set({BRANCH}) OVER (PARTITION BY __spec, DN) AS __held"
    gone = "DN IS NOT NULL AND array_contains(__held, __source)"
    return df.selectExpr("*", held).filter(f"NOT coalesce({gone}, false)").drop("__held")


def _finish(df: DataFrame, specs: list[StateRoundSpec], books: Codebook, geo, remap, carry=()) -> DataFrame:
    branches = [b for s in specs for b in s.branches]
    numbers = _numbers(specs)
    df = df.join(rule_table(df.sparkSession, _branch_rows(specs), _BRANCH_SCHEMA), BRANCH)

    seq, kinds = "N_PARTY", {b.ordering for b in branches}
    if "party" in kinds:
        seq = f"CASE WHEN __ordering = 'party' THEN PARTY ELSE {seq} END"
    if "vendor" in kinds:
        maps = {b.branch_id: b.vendors for b in branches if b.ordering == "vendor"}
        df = decode.assign_ordering(df, maps, out="__vseq", branch_col="branch_id")
        seq = f"CASE WHEN __ordering = 'vendor' THEN __vseq ELSE {seq} END"
    if kinds != {"n_party"}:
        df = df.withColumn("N_PARTY", F.expr(seq))

    labels = []
    if any(b.book for b in branches):
        df = decode.decode_first(df, books, out="__r1", book_col="__book")
        labels.append("__r1")
    if any(b.spelling for b in branches):
        labels.append(decode.spelled_sql("N_PARTY", "DTMF_REP", "__base", "__letters"))
    df = df.withColumns({
        "RES1": F.expr(f"coalesce({', '.join(labels)})"),
        "AC_ID": fn.ac_id("STATE_CODE", "AC_NO"),
        "PC_ID": fn.pc_id("STATE_CODE", "PC_NO"),
    }).filter("RES1 <> ''")
    df = _post_filter(_geo_checked(df, branches, geo, remap), branches, numbers)
    if any(b.exclude_numbers_of for b in branches):
        df = _excluded(df)
    hidden = [numbers[b.branch_id] for b in branches if not b.emit]
    if hidden:
        df = df.filter(f"{BRANCH} NOT IN ({fn.numbers(hidden)})")
    rules = {b.branch_id: b.recode for b in branches if b.recode}
    if rules:
        df = decode.recode(df, rules, branch_col="branch_id")
    later = [numbers[b.branch_id] for b in branches if b.later_keys]
    if later:
        df = decode.decode_later(df, books, book_col="__book")
        if len(later) < len(branches):
            res2 = f"CASE WHEN {BRANCH} IN ({fn.numbers(later)}) THEN RES2 ELSE '' END"
            df = df.withColumn("RES2", F.expr(res2))
    else:
        df = df.withColumn("RES2", F.lit(""))

    if any(s.dedup_after_union for s in specs):
        # A state that keeps duplicates across branches has the branch in __unit, so one pass
        # serves all states. The exclusion above leaves the rows partitioned for it.
        df = dedup.latest_per_key(df, ["__spec", "DN", "__unit"], tie=["branch_id"])
    start = "Start_Time"
    if all(s.date_only for s in specs):
        start = "CAST(Start_Time AS DATE) AS Start_Time"
    elif any(s.date_only for s in specs):
        kind = df.schema["Start_Time"].dataType.simpleString()
        start = f"CASE WHEN __day THEN CAST(CAST(Start_Time AS DATE) AS {kind}) ELSE Start_Time END AS Start_Time"
    return df.selectExpr(*[start if c == "Start_Time" else c for c in S.CANONICAL_COLUMNS], "ROUND", *carry)


# What a score depends on. Calls that agree on all of these score alike, whichever is kept.
SCORED = ["STATE_CODE", "state", "DTMF_REP", "N_PARTY", "PARTY", "VENDOR_ID", "AC_NO", "PC_NO"]


def build_rounds(raw: DataFrame, specs: list[StateRoundSpec], books: Codebook | None = None,
                 geo: DataFrame | None = None, geo_remap: DataFrame | None = None,
                 tie: list[str] | None = None, by_number: bool = False) -> DataFrame:
    """Canonical responses of all specs, tagged with ROUND, from one scan per de-duplication rule.

    ``tie`` orders calls of one number at one time (default: all columns). With ``SCORED`` the
    scan can skip respondent details that only the canonical rows carry. With ``by_number`` the
    de-duplicated calls are stored in buckets by number first: exclusions and de-duplication across
    branches then have no exchange, and what they need is not worked out again for a second look.
    """
    S.require(raw, ["Campaign_Name", *_USED], "raw calls")
    branches = [b for s in specs for b in s.branches]
    books = Codebook() if books is None else books
    rows = _collapsed(raw, branches, _numbers(specs), tie)
    return _finish(store_by_number(rows) if by_number else rows, specs, books, geo, geo_remap)


def build_round(raw: DataFrame, specs, books: Codebook | None = None, geo=None, geo_remap=None) -> DataFrame:
    """Canonical responses of one round (one spec or a list of state specs), fifteen columns."""
    specs = [specs] if isinstance(specs, StateRoundSpec) else list(specs)
    return build_rounds(raw, specs, books, geo, geo_remap).select(*S.CANONICAL_COLUMNS)


def build_by_branch(raw: DataFrame, specs, books: Codebook | None = None, geo=None,
                    geo_remap=None) -> DataFrame:
    """The same result with one scan per branch: the form a reader would write by hand."""
    specs = [specs] if isinstance(specs, StateRoundSpec) else list(specs)
    numbers = _numbers(specs)
    rows = union_all([_collapsed(raw, [b], numbers) for s in specs for b in s.branches])
    return _finish(rows, specs, Codebook() if books is None else books, geo, geo_remap).select(*S.CANONICAL_COLUMNS)
