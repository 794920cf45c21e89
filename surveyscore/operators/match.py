"""Calls to branches that are rows of a table, however many there are.

Compiled branches become literals of one plan, which suits dozens. Here no branch reaches the plan:
the literal beginnings and ends of their patterns are an index, by length and text. A call probes
the few lengths that occur, an equi-join finds the patterns that may fit, and the rest of each
branch's condition is checked on the pair.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore.rules import broadcast_if_small
from surveyscore.sources.sinks import materialise

#: What a branch may ask of a call; every column but the first two may be NULL, which asks nothing.
BRANCHES = ("branch_id string, campaign_like array<string>, campaign_not_like array<string>, state_prefix string,"
            " q2_type string, start timestamp_ntz, end timestamp_ntz, pc_in array<int>, pc_not_in array<int>")
_COLUMNS = [c.split()[0] for c in BRANCHES.split(", ")]

#: What a branch may ask besides its patterns, by the columns of the call and of the branch.
_ASKED = ["state_prefix", "q2_type", "start", "end", "pc_in", "pc_not_in"]
_CALL = ["Campaign_Name", "state", "Q2_Type", "Start_Time", "PC_NO"]
_REST = """(b_state_prefix IS NULL OR upper(state) LIKE upper(b_state_prefix))
        AND (b_q2_type IS NULL OR Q2_Type = b_q2_type)
        AND (b_start IS NULL OR Start_Time >= b_start) AND (b_end_time IS NULL OR Start_Time < b_end_time)
        AND (b_pc_in IS NULL OR array_contains(b_pc_in, PC_NO))
        AND (b_pc_not_in IS NULL OR NOT array_contains(b_pc_not_in, PC_NO))"""
MOST_TIMES = 64  # distinct starts and ends of branches up to which times are cut to them before counting


def _own(columns) -> list[str]:
    """SQL that names a branch's columns apart from a call's."""
    return [f"{c} AS b_{'end_time' if c == 'end' else c}" for c in columns]


def _parsed(pattern: str) -> str:
    """SQL for what a LIKE pattern asks: most are a text, a beginning and an end, or a text within."""
    begin, rest = rf"regexp_extract({pattern}, '^[^%_\\\\]*', 0)", rf"regexp_extract({pattern}, '[^%_\\\\]*$', 0)"
    inner = rf"regexp_extract({pattern}, '^%([^%_\\\\]+)%$', 1)"
    kind = f"""CASE WHEN {begin} = {pattern} THEN 'text' WHEN {inner} <> '' THEN 'inner'
        WHEN contains({pattern}, '%') AND length({begin}) + length({rest}) + 1 = length({pattern}) THEN 'ends' ELSE 'like' END"""
    return f"named_struct('p', {pattern}, 'kind', {kind}, 'a', CASE WHEN {inner} <> '' THEN {inner} ELSE {begin} END, 'z', {rest})"


def _fits(parsed: str) -> str:
    """SQL for whether a campaign name fits; only patterns of other shapes are matched as such."""
    return f"""CASE {parsed}.kind WHEN 'text' THEN Campaign_Name = {parsed}.p WHEN 'inner' THEN contains(Campaign_Name, {parsed}.a)
        WHEN 'ends' THEN startswith(Campaign_Name, {parsed}.a) AND endswith(Campaign_Name, {parsed}.z)
            AND length(Campaign_Name) >= length({parsed}.a) + length({parsed}.z)
        ELSE Campaign_Name LIKE {parsed}.p END"""


def pattern_index(branches: DataFrame) -> DataFrame:
    """One row per branch and pattern, with the longer of the texts that it begins and ends with."""
    rows = branches.selectExpr(*_COLUMNS).selectExpr(*_own(_COLUMNS))
    parsed = f"transform(array_distinct(filter(b_campaign_like, p -> p IS NOT NULL)), p -> {_parsed('p')})"
    none = f"transform(filter(b_campaign_not_like, p -> p IS NOT NULL), p -> {_parsed('p')})"
    rows = rows.selectExpr("*", f"{parsed} AS b_all", f"{none} AS b_none").drop("b_campaign_like", "b_campaign_not_like")
    listed = rows.selectExpr("*", "posexplode(b_all) AS (b_pos, b_one)").selectExpr("*", "slice(b_all, 1, b_pos) AS b_earlier").drop("b_all")
    # After an escape a wildcard is a letter, so such a pattern's end is not taken as it stands.
    listed = listed.selectExpr("*", r"CASE WHEN contains(b_one.p, '\\') THEN '' ELSE b_one.z END AS b_end",
                               "CASE WHEN b_one.kind = 'inner' THEN '' ELSE b_one.a END AS b_begin")
    listed = listed.withColumn("b_back", F.expr("length(b_end) > length(b_begin)"))
    listed = listed.withColumn("b_anchor", F.expr("CASE WHEN b_back THEN b_end ELSE b_begin END"))
    return listed.withColumn("b_length", F.length("b_anchor"))


def match_branches(calls: DataFrame, branches: DataFrame) -> DataFrame:
    """Every call with each branch that it belongs to, once: the call's columns and branch_id.

    ``branches`` has the columns of ``BRANCHES``; one without a pattern takes no call. A call fits
    if one of the patterns fits its Campaign_Name and no excluded one does, and the other conditions
    hold; a NULL in the call meets none. Branches are broadcast if few, else joined by the indexed
    text, where Spark splits one that very many calls share.
    """
    index = materialise(pattern_index(branches), "patterns")
    # At most twice as many as a campaign name has letters.
    kinds = sorted(tuple(r) for r in index.select("b_back", "b_length").distinct().collect())
    looks = F.array(*[F.struct(F.lit(back).alias("back"), F.lit(n).alias("n")) for back, n in kinds]).cast("array<struct<back:boolean,n:int>>")
    probes = calls.withColumn("b_probe", F.explode(looks)).where("length(Campaign_Name) >= b_probe.n")
    probes = probes.withColumn("b_text", F.expr("CASE WHEN b_probe.back THEN right(Campaign_Name, b_probe.n) ELSE left(Campaign_Name, b_probe.n) END"))
    fits = f"""b_text = b_anchor AND b_probe.n = b_length AND b_probe.back = b_back AND {_fits('b_one')} AND {_REST}
        AND (size(b_earlier) = 0 OR NOT exists(b_earlier, e -> Campaign_Name LIKE e.p))
        AND (b_none IS NULL OR NOT exists(b_none, e -> Campaign_Name LIKE e.p))"""
    found = probes.join(broadcast_if_small(index), F.expr(fits))
    return found.select(*calls.columns, F.col("b_branch_id").alias("branch_id"))


def count_branches(calls: DataFrame, branches: DataFrame, first: str) -> DataFrame:
    """Calls of each branch that has any: branch_id, n_calls and first_call, the least ``first``.

    The same as counting ``match_branches``, repeated branch rows included, without its pairs of calls
    and branches. Calls that no branch tells apart are counted first, and names are matched to sets
    of patterns. Branches that ask the same besides patterns share one count per name, so the pairs
    looked at are those of counted calls and distinct conditions on one name.
    """
    asked = materialise(branches.selectExpr(*_COLUMNS), "branches")
    grouped = _cut_times(calls.select(*_CALL, F.col(first).alias("first_call")), asked).groupBy(*_CALL).agg(
        F.count("*").alias("n_calls"), F.min("first_call").alias("first_call"))
    grouped = materialise(grouped.where("Campaign_Name IS NOT NULL"), "counted-calls")
    like = ["campaign_like", "campaign_not_like"]
    sets = materialise(asked.select(*like).distinct().withColumn("set_id", F.monotonically_increasing_id().cast("string")), "pattern-sets")
    rests = materialise(asked.select(*_ASKED).distinct().withColumn("rest_id", F.monotonically_increasing_id()), "conditions")
    same = lambda other, columns: F.expr(" AND ".join(f"a.{c} <=> {other}.{c}" for c in columns))
    named = asked.alias("a").join(sets.alias("s"), same("s", like)).join(rests.alias("r"), same("r", _ASKED)).select(
        "a.branch_id", "s.set_id", "r.rest_id")
    named = materialise(named, "numbered-branches")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in asked.schema if f.name in _ASKED]
    names = grouped.select("Campaign_Name").distinct().select(
        "Campaign_Name", *[F.lit(None).cast(grouped.schema[c].dataType).alias(c) for c in _CALL[1:]])
    fitting = match_branches(names, sets.select(F.col("set_id").alias("branch_id"), *like, *none))
    fitting = materialise(fitting.select("Campaign_Name", F.col("branch_id").alias("set_id")), "fitting-names")
    wanted = fitting.join(named.select("set_id", "rest_id").distinct(), "set_id").select("Campaign_Name", "rest_id").distinct()
    wanted = wanted.join(rests.selectExpr("rest_id", *_own(_ASKED)), "rest_id")
    counted = materialise(grouped.join(broadcast_if_small(materialise(wanted, "wanted")), "Campaign_Name").where(_REST).groupBy("Campaign_Name", "rest_id").agg(
        F.sum("n_calls").alias("n_calls"), F.min("first_call").alias("first_call")), "counts")
    by_set = fitting.join(counted, "Campaign_Name").groupBy("set_id", "rest_id").agg(
        F.sum("n_calls").alias("n_calls"), F.min("first_call").alias("first_call"))
    return named.join(by_set, ["set_id", "rest_id"]).groupBy("branch_id").agg(
        F.sum("n_calls").alias("n_calls"), F.min("first_call").alias("first_call"))


def _cut_times(calls: DataFrame, asked: DataFrame) -> DataFrame:
    """Calls with the latest start or end of any branch that is not after their time, where these are few.

    No branch tells two times with the same one apart. Beyond ``MOST_TIMES`` times stay as they are.
    """
    kind = calls.schema["Start_Time"].dataType
    times = asked.select(F.explode(F.array("start", "end")).alias("t")).where("t IS NOT NULL").distinct()
    found = sorted(r.t for r in times.limit(MOST_TIMES + 1).collect())
    if kind.typeName() not in ("timestamp", "timestamp_ntz") or len(found) > MOST_TIMES or found and found[0].year < 2:
        return calls
    if not found:
        return calls.withColumn("Start_Time", F.lit(None).cast(kind))
    at = [F.lit(t).cast("timestamp_ntz") for t in (found[0] - timedelta(days=1), *found)]
    late = [F.when(F.col("Start_Time") >= t, t.cast(kind)) for t in at[1:]]
    return calls.withColumn("Start_Time", F.when(F.col("Start_Time").isNotNull(), F.greatest(at[0].cast(kind), *late)))
