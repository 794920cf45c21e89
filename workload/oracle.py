"""The same results in plain SQL, for an independent engine.

The SQL is written the direct way: one scan per branch, decode rules as CASE arms with LIKE,
ranking by ROW_NUMBER, one grouping per scope.
"""

from __future__ import annotations

from surveyscore import schema as S
from surveyscore.operators.decode import Arm
from workload import adapter as A

RAW = """raw AS MATERIALIZED (
  SELECT o_orderkey AS CALL_ID,
    CASE WHEN o_orderkey % 251 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS DN,
    'R' || n_regionkey || '-' || CASE o_orderstatus WHEN 'F' THEN 'BC' WHEN 'O' THEN 'EP' ELSE 'PP' END
      || '-PC' || n_nationkey || CASE WHEN o_orderkey % 2 = 0 THEN '-LSE' ELSE '-PM' END AS Campaign_Name,
    CAST(o_orderkey % 12 + 1 AS INTEGER) AS VENDOR_ID,
    o_orderdate AS Start_Time,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''
      WHEN o_orderkey % 97 = 0 THEN ',,' WHEN o_orderkey % 7 = 0 THEN substr(o_orderpriority, 1, 1)
      WHEN o_orderkey % 13 = 0 THEN substr(o_orderpriority, 1, 1) || (o_orderkey % 5 + 1)
      WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 1, 1) || ',' || (o_orderkey % 5 + 1)
      ELSE substr(o_orderpriority, 1, 1) || ',' || (o_orderkey % 5 + 1) || ',' || ((o_orderkey + 2) % 5 + 1)
      END AS DTMF_REP,
    CASE WHEN o_totalprice >= 250000 THEN 'ABCDO' ELSE 'BAO' END AS PARTY,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ABCDO' WHEN 'BUILDING' THEN 'BCDAO' WHEN 'FURNITURE' THEN 'CDABO'
      WHEN 'HOUSEHOLD' THEN 'DABCO' ELSE 'BAO' END AS N_PARTY,
    CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST(n_nationkey % 18 * 10 + c_custkey % 10 AS INTEGER) END AS AC_NO,
    n_nationkey AS PC_NO,
    CAST(o_custkey % 30 AS VARCHAR) AS PART_NO,
    CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS GENDER,
    CAST(18 + o_custkey % 60 AS INTEGER) AS AGE,
    'C' || (o_custkey % 4) AS CASTE,
    r_name AS state,
    CASE WHEN o_orderkey % 2 = 0 THEN 'LSE_2019' ELSE 'PM_2024' END AS Q2_Type
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_SUPPLIED = "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_AC = "CAST(n_nationkey % 18 * 10 + s_suppkey % 10 AS INTEGER)"
GEO = f"geo AS (SELECT 'R' || n_regionkey AS State_Code, {_AC} AS AC_NO {_SUPPLIED})"
REMAP = f"""remap AS (SELECT 'R' || n_regionkey AS State_Code, {_AC} AS AC_NO,
  CAST(n_nationkey * 2 + (s_suppkey % 10) // 5 AS INTEGER) AS PC_No {_SUPPLIED})"""
REGION = f"""regions AS (SELECT 'R' || n_regionkey || '-AC-' || {_AC} AS AC_ID,
  'R' || n_regionkey || '-' || n_nationkey AS PC_ID,
  min(r_name || CASE WHEN s_suppkey % 10 < 5 THEN ' NORTH' ELSE ' SOUTH' END) AS REGION
  {_SUPPLIED} GROUP BY 1, 2)"""

VALID = "DTMF_REP IS NOT NULL AND DTMF_REP <> '' AND DTMF_REP <> ',,'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def case_first(arms, seq="N_PARTY", ans="DTMF_REP") -> str:
    test = {
        "both": f"({ans} LIKE '{{d}},%' OR {ans} LIKE '{{d}}')",
        "prefix": f"{ans} LIKE '{{d}},%'",
        "exact": f"{ans} LIKE '{{d}}'",
    }
    lines = [
        f"WHEN {seq} = '{a.ordering}' AND {test[a.form].format(d=a.digit)} THEN '{a.label}'"
        for a in arms if a.position == 1
    ]
    return "CASE " + "\n".join(lines) + " ELSE NULL END"


def case_later(arms, seq="N_PARTY", ans="DTMF_REP") -> str:
    lines = [
        f"WHEN {seq} = '{a.ordering}' AND {ans} LIKE '%,{a.digit}%' THEN '{a.label}'"
        for a in arms if a.position == 2
    ]
    return "CASE " + "\n".join(lines) + " ELSE NULL END"


# The labels of the first keys, written out by hand so that the spelling rule is checked, not repeated.
_KEYS = {
    "ABCDO": ("1 ALPHA", "2 BRAVO", "3 CHARLIE", "4 DELTA", "5 OTHERS"),
    "BCDAO": ("1 BRAVO", "2 CHARLIE", "3 DELTA", "4 ALPHA", "5 OTHERS"),
    "CDABO": ("1 CHARLIE", "2 DELTA", "3 ALPHA", "4 BRAVO", "5 OTHERS"),
    "DABCO": ("1 DELTA", "2 ALPHA", "3 BRAVO", "4 CHARLIE", "5 OTHERS"),
    "BAO": ("1 BRAVO", "2 ALPHA", "4 OTHERS"),
}
MAIN = [Arm(1, code, *key.split()) for code, keys in _KEYS.items() for key in keys] + A.later_arms()
MIXED = A.books().books["mixed"]
CODE = "substr(Campaign_Name, 1, 2)"

# Latest call per state, round and number; then drop what does not decode.
RESP = f"""resp AS MATERIALIZED (
  SELECT DN, Start_Time, DTMF_REP, state, {CODE} || '-AC-' || AC_NO AS AC_ID, AC_NO,
    {CODE} || '-' || PC_NO AS PC_ID, PC_NO, PART_NO, GENDER, AGE, N_PARTY, RES1, '' AS RES2, CASTE,
    substr(Campaign_Name, 4, 2) AS ROUND
  FROM (SELECT *, {case_first(MAIN)} AS RES1,
      row_number() OVER (PARTITION BY substr(Campaign_Name, 1, 5), DN ORDER BY Start_Time DESC, CALL_ID DESC) AS rn
    FROM raw)
  WHERE rn = 1 AND RES1 IS NOT NULL)"""
BASE = with_(RAW, RESP)


# ---- scoring -----------------------------------------------------------------------------


def _band(m: str) -> str:
    return (f"CASE WHEN {m} >= 0 AND {m} <= 5 THEN '0-5%' WHEN {m} > 5 AND {m} <= 10 THEN '6-10%' "
            f"WHEN {m} > 10 AND {m} <= 20 THEN '11-20%' WHEN {m} > 20 AND {m} <= 30 THEN '21-30%' "
            "ELSE 'Above 30%' END")


def _h(c: str) -> str:
    return f"CASE WHEN t > 0 THEN (20000 * {c} + t) // (2 * t) END"


def scope_ctes(name: str, src: str = "resp", by: tuple = (), tie: str = "first") -> str:
    """CTEs ending in ``m_<name>``: one row per scope key and label with the nine metrics."""
    s = S.SCOPES[name]
    keys = [*by, *s.keys]
    k = ", ".join(keys)
    same = " AND ".join(f"r.{x} IS NOT DISTINCT FROM f.{x}" for x in keys)
    known = " AND ".join(f"{x} IS NOT NULL" for x in s.keys)
    won = "w" if tie == "first" else "CASE WHEN c1 = c2 THEN 'DRAW' ELSE w END"
    return f"""c_{name} AS (SELECT {k}, RES1, CAST(count(DN) AS BIGINT) AS c FROM {src} GROUP BY {k}, RES1),
r_{name} AS (SELECT *, CAST(sum(c) OVER (PARTITION BY {k}) AS BIGINT) AS t,
    row_number() OVER (PARTITION BY {k} ORDER BY c DESC, RES1) AS rn FROM c_{name}),
f_{name} AS (SELECT {k}, max(CASE WHEN rn = 1 THEN RES1 END) AS w, max(CASE WHEN rn = 1 THEN c END) AS c1,
    max(CASE WHEN rn = 2 THEN RES1 END) AS u, max(CASE WHEN rn = 2 THEN c END) AS c2 FROM r_{name} GROUP BY {k}),
h_{name} AS (SELECT {', '.join('r.' + x for x in keys)}, r.RES1, c, {_h('c')} AS h, {_h('c1')} AS h1,
    CASE WHEN {known.replace(' AND ', ' AND r.').replace(s.keys[0], 'r.' + s.keys[0], 1)} THEN {_h('c2')} END AS h2,
    CASE WHEN {known.replace(' AND ', ' AND r.').replace(s.keys[0], 'r.' + s.keys[0], 1)} THEN {won} END AS w,
    CASE WHEN {known.replace(' AND ', ' AND r.').replace(s.keys[0], 'r.' + s.keys[0], 1)} THEN u END AS u
  FROM r_{name} r JOIN f_{name} f ON {same}),
g_{name} AS (SELECT *, CAST(h1 - h2 AS DOUBLE) / 100.0::DOUBLE AS m FROM h_{name}),
m_{name} AS (SELECT {k}, RES1, c AS "{s.count}", CAST(h AS DOUBLE) / 100.0::DOUBLE AS "{s.pct}",
    CAST(h1 AS DOUBLE) / 100.0::DOUBLE AS "{s.max_pct}", w AS "{s.winner}",
    CAST(h2 AS DOUBLE) / 100.0::DOUBLE AS "{s.second}", u AS "{s.runner_up}", m AS "{s.margin}",
    {_band('m')} AS "{s.band}",
    CASE WHEN w = 'DRAW' THEN 'DRAW' ELSE w || ' ' || CAST(m AS VARCHAR) || ' (' || u || ')' END AS "{s.summary}"
  FROM g_{name})"""


def q(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def score_ctes(scopes, src="resp", by: tuple = (), out="scored") -> str:
    """CTEs ending in ``scored``: one row per row key, metrics of the scopes side by side."""
    by_sql = "".join(f"{b}, " for b in by)
    parts = [scope_ctes(s, src, by) for s in scopes]
    parts.append(f"""base AS (SELECT {by_sql}AC_ID, PC_ID, N_PARTY, RES1, min(AC_NO) AS AC_NO, min(PC_NO) AS PC_NO,
    min(state) AS state FROM {src} GROUP BY {by_sql}AC_ID, PC_ID, N_PARTY, RES1)""")
    joins = ""
    for s in scopes:
        on = " AND ".join(f"b.{x} IS NOT DISTINCT FROM m_{s}.{x}" for x in [*by, *S.SCOPES[s].keys, "RES1"])
        joins += f" JOIN m_{s} ON {on}"
    metrics = ", ".join(f'm_{s}."{c}"' for s in scopes for c in S.SCOPES[s].columns)
    front = ", ".join(f"b.{c}" for c in S.SCORE_KEYS)
    tail = "".join(f", b.{b}" for b in by)
    parts.append(f"{out} AS (SELECT {front}, {metrics}{tail} FROM base b{joins})")
    return ",\n".join(parts)


def scored(scopes, select="SELECT * FROM scored", src="resp", by=(), extra=()) -> str:
    return with_(RAW, RESP, *extra, score_ctes(scopes, src, by)) + select


ALL = ["ac", "pc", "seq_ac", "seq_pc"]
# Every round, and all of them again as the pooled round.
POOL = "pool AS (SELECT * FROM resp UNION ALL SELECT * REPLACE ('COM' AS ROUND) FROM resp)"
# A pooled region map: one row per AC.
REGION_AC = "region_ac AS (SELECT AC_ID, min(REGION) AS REGION FROM regions GROUP BY 1)"
REGIONS = (REGION, REGION_AC)


def one_scope(name, select, tie="first") -> str:
    return with_(RAW, RESP, scope_ctes(name, tie=tie)) + select


LONG = with_(RAW, RESP, POOL, score_ctes(ALL, "pool", ("ROUND",)))

ORACLE: dict[str, str] = {}

# ---- sources, filters, projections -------------------------------------------------------

W = with_(RAW)
ORACLE["scan_campaign"] = W + "SELECT CALL_ID, Campaign_Name, DTMF_REP FROM raw WHERE Campaign_Name LIKE 'R3-EP%'"
ORACLE["scan_many_union"] = W + " UNION ALL ".join(
    f"SELECT CALL_ID, DN, Campaign_Name, DTMF_REP FROM raw WHERE Campaign_Name LIKE 'R_-{r}-%'" for r in A.ROUNDS
)
ORACLE["dim_region"] = with_(*REGIONS) + "SELECT * FROM region_ac"
ORACLE["materialise_join"] = with_(RAW, RESP, *REGIONS, score_ctes(["ac"], out="ac"), *[
    scope_ctes("pc")
]) + f"""SELECT {', '.join('a.' + c for c in S.SCORE_KEYS)}, {q(S.SCOPES['ac'].columns)},
  {q(S.SCOPES['pc'].columns)}, REGION, 'ALL' AS ROUND
  FROM ac a LEFT JOIN m_pc ON a.PC_ID = m_pc.PC_ID AND a.RES1 = m_pc.RES1 AND a.AC_ID IS NOT NULL
  LEFT JOIN region_ac g ON a.AC_ID = g.AC_ID"""

ORACLE["filter_valid_answer"] = W + f"SELECT CALL_ID, DTMF_REP FROM raw WHERE {VALID}"
ORACLE["filter_campaign_like"] = W + "SELECT CALL_ID, Campaign_Name FROM raw WHERE Campaign_Name LIKE 'R_-EP-PC%-LSE'"
ORACLE["filter_campaign_any"] = W + """SELECT CALL_ID, Campaign_Name FROM raw
  WHERE Campaign_Name LIKE 'R0-BC-PC%' OR Campaign_Name LIKE 'R3-PP-%' OR Campaign_Name LIKE '%-PC1_-PM'"""
ORACLE["filter_campaign_not_like"] = W + """SELECT CALL_ID, Campaign_Name FROM raw
  WHERE Campaign_Name NOT LIKE 'R2-EP%' AND Campaign_Name NOT LIKE 'R4-%'"""
ORACLE["filter_state_prefix"] = W + "SELECT CALL_ID, state FROM raw WHERE state ILIKE 'middle_e%'"
ORACLE["filter_qtype"] = W + "SELECT CALL_ID, Q2_Type FROM raw WHERE Q2_Type = 'PM_2024'"
ORACLE["filter_time_window"] = W + """SELECT CALL_ID, Start_Time FROM raw
  WHERE Start_Time >= TIMESTAMP '1996-02-01' AND Start_Time < TIMESTAMP '1997-03-01'
  OR Start_Time BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-01-01'"""
ORACLE["filter_pc_in"] = W + "SELECT CALL_ID, PC_NO FROM raw WHERE PC_NO IN (2, 7, 11)"
_NUMS = ", ".join(map(str, A.NUMBERS))
ORACLE["filter_pc_not_in"] = W + f"SELECT CALL_ID, PC_NO FROM raw WHERE PC_NO IS NOT NULL AND PC_NO NOT IN ({_NUMS})"
ORACLE["filter_decoded"] = W + f"""SELECT * FROM (SELECT CALL_ID, {case_first(MAIN)} AS RES1 FROM raw)
  WHERE RES1 IS NOT NULL AND RES1 <> ''"""
ORACLE["filter_post_branch"] = W + """SELECT CALL_ID, PC_NO, Q2_Type FROM raw WHERE Q2_Type = 'LSE_2019'
  UNION ALL SELECT CALL_ID, PC_NO, Q2_Type FROM raw
  WHERE Q2_Type = 'PM_2024' AND Start_Time < TIMESTAMP '1999-01-01' AND PC_NO BETWEEN 5 AND 14"""
ORACLE["project_canonical"] = W + f"""SELECT DN, CAST(Start_Time AS DATE) AS Start_Time, DTMF_REP, state,
  {CODE} || '-AC-' || AC_NO AS AC_ID, AC_NO, {CODE} || '-' || PC_NO AS PC_ID, PC_NO, PART_NO, GENDER, AGE,
  PARTY AS N_PARTY, CASE WHEN strpos(DTMF_REP, ',') > 0 THEN substr(DTMF_REP, 1, strpos(DTMF_REP, ',') - 1)
  ELSE DTMF_REP END AS RES1, '' AS RES2, CASTE FROM raw"""
ORACLE["project_constants"] = W + """SELECT CALL_ID, DN, '' AS RES2, 'Ruritania' AS state_name, 0 AS VALID_NUM,
  CAST(NULL AS INTEGER) AS VENDOR_NO FROM raw"""
ORACLE["clean_scores"] = BASE + """SELECT AC_ID, PC_ID, N_PARTY, RES1, state, AC_NO, PC_NO, ROUND FROM (
  SELECT *, row_number() OVER (PARTITION BY AC_ID, PC_ID, N_PARTY, RES1
    ORDER BY state NULLS FIRST, AC_NO NULLS FIRST, PC_NO NULLS FIRST, ROUND NULLS FIRST) AS rn FROM resp) WHERE rn = 1"""
ORACLE["reorder_scores"] = scored(["seq_pc"])
ORACLE["wide_layout"] = scored(ALL, f"""SELECT {', '.join('s."' + c + '"' for c in S.WIDE_LAYOUT[:-2])},
  REGION, 'ALL' AS ROUND FROM scored s LEFT JOIN region_ac g ON s.AC_ID = g.AC_ID""", extra=REGIONS)
ORACLE["tag_round"] = W + "SELECT CALL_ID, DN, 'BC' AS ROUND FROM raw"

# ---- decoding ----------------------------------------------------------------------------

_DEC = "SELECT CALL_ID, N_PARTY, DTMF_REP, {} AS {} FROM raw"
ORACLE["decode_first"] = W + _DEC.format(case_first(MAIN), "RES1")
ORACLE["decode_spelled"] = ORACLE["decode_first"]
ORACLE["decode_first_forms"] = W + _DEC.format(case_first(MIXED), "RES1")
ORACLE["decode_first_stored_book"] = W + f"""SELECT CALL_ID, {case_first(MIXED)} AS RES1,
  {case_later(MAIN)} AS RES2 FROM raw"""
ORACLE["decode_later"] = W + _DEC.format(case_later(MAIN), "RES2")


def vendor_case(vendors) -> str:
    arms = " ".join(f"WHEN VENDOR_ID IN ({', '.join(str(int(i)) for i in ids)}) THEN '{code}'"
                    for code, ids in vendors.items())
    return f"CASE {arms} ELSE 'SET_SEQ' END"


ORACLE["assign_ordering"] = W + f"""SELECT CALL_ID, VENDOR_ID, SEQ, {case_first(MAIN, 'SEQ')} AS RES1
  FROM (SELECT *, {vendor_case(A.VENDORS)} AS SEQ FROM raw)"""
ORACLE["ordering_from_col"] = W + f"""SELECT * FROM (SELECT CALL_ID, PARTY AS SEQ,
  {case_first(MAIN, 'PARTY')} AS RES1 FROM raw) WHERE RES1 IS NOT NULL"""


def recode_case(rules) -> str:
    def quoted(xs):
        return ", ".join(f"'{x}'" for x in xs)
    arms = " ".join(f"WHEN PC_ID IN ({quoted(r.pc_ids)}) AND RES1 IN ({quoted(r.labels)}) THEN '{r.to}'" for r in rules)
    return f"CASE {arms} ELSE RES1 END"


ORACLE["recode_alliance"] = W + f"""SELECT CALL_ID, PC_ID, {recode_case([r for s in A.STATES for r in A.recodes(s)])} AS RES1
  FROM (SELECT CALL_ID, {CODE} || '-' || PC_NO AS PC_ID, {case_first(MAIN)} AS RES1 FROM raw) WHERE RES1 IS NOT NULL"""
ORACLE["derive_ids"] = W + f"""SELECT CALL_ID, {CODE} AS STATE_CODE, {CODE} || '-AC-' || AC_NO AS AC_ID,
  {CODE} || '-' || PC_NO AS PC_ID FROM raw"""

# ---- de-duplication ----------------------------------------------------------------------

_LATEST = "row_number() OVER (PARTITION BY {} ORDER BY Start_Time DESC, CALL_ID DESC) AS rn"
ORACLE["dedup_latest"] = W + f"""SELECT DN, Start_Time, CALL_ID, DTMF_REP, N_PARTY, RES1 FROM (
  SELECT *, {case_first(MAIN)} AS RES1, {_LATEST.format('DN')} FROM raw) WHERE rn = 1 AND RES1 IS NOT NULL"""
ORACLE["dedup_latest_events"] = """SELECT event_id, ts, user_id, event_type FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
ORACLE["dedup_latest_union"] = W + f"""SELECT DN, Start_Time, CALL_ID, DTMF_REP, N_PARTY, Q2_Type, RES1 FROM (
  SELECT *, {_LATEST.format('DN').replace(' rn', ' again')} FROM (
    SELECT *, {case_first(MAIN)} AS RES1, {_LATEST.format('Q2_Type, DN')} FROM raw)
  WHERE rn = 1 AND RES1 IS NOT NULL) WHERE again = 1"""
_MAXED = ["Campaign_Name", "VENDOR_ID", "Start_Time", "DTMF_REP", "PARTY", "AC_NO", "PC_NO", "PART_NO", "AGE"]
ORACLE["dedup_colmax"] = W + f"""SELECT DN, {', '.join(f'max({c}) AS {c}' for c in _MAXED)}
  FROM raw WHERE {VALID} GROUP BY DN"""

# ---- joins -------------------------------------------------------------------------------

ORACLE["join_geo_semi"] = with_(RAW, GEO) + """SELECT CALL_ID, AC_NO FROM raw
  WHERE EXISTS (SELECT 1 FROM geo WHERE geo.AC_NO = raw.AC_NO AND State_Code = substr(Campaign_Name, 1, 2)
    AND State_Code IN ('R0', 'R2'))"""
ORACLE["join_geo_fan_out"] = with_(RAW, GEO) + """SELECT t.CALL_ID, t.AC_NO FROM raw t
  JOIN geo b ON t.AC_NO = b.AC_NO AND b.State_Code = substr(Campaign_Name, 1, 2) WHERE b.State_Code IN ('R0', 'R2')"""
ORACLE["join_geo_remap"] = with_(RAW, REMAP) + """SELECT CALL_ID, t.AC_NO, b.PC_No AS PC_NO,
  b.State_Code || '-' || b.PC_No AS PC_ID
  FROM raw t JOIN (SELECT DISTINCT * FROM remap WHERE State_Code = 'R1') b
  ON t.AC_NO = b.AC_NO AND b.State_Code = substr(Campaign_Name, 1, 2)"""
ORACLE["join_region_left"] = with_(RAW, RESP, *REGIONS) + """SELECT DN, ROUND, r.AC_ID, RES1, REGION
  FROM resp r LEFT JOIN region_ac g ON r.AC_ID = g.AC_ID"""
ORACLE["join_region_left2"] = with_(RAW, RESP, REGION) + """SELECT DN, ROUND, r.AC_ID, r.PC_ID, RES1, REGION
  FROM resp r LEFT JOIN regions g ON r.AC_ID = g.AC_ID AND r.PC_ID = g.PC_ID"""
ORACLE["anti_join_numbers"] = W + """SELECT CALL_ID, DN FROM raw t WHERE NOT EXISTS (SELECT 1 FROM raw x
  WHERE x.Campaign_Name LIKE '%-EP-%' AND x.Start_Time >= TIMESTAMP '1999-01-01' AND x.DN = t.DN)"""
ORACLE["combine_scopes"] = scored(ALL)


def wide(scopes, rounds, src, keep_from=None, start=None) -> str:
    attrs = "min(AC_NO) AS AC_NO, min(PC_NO) AS PC_NO, min(state) AS state"
    cols = ", ".join(f"max(CASE WHEN ROUND = '{r}' THEN \"{c}\" END) AS \"{r}_{c}\""
                     for r in rounds for s in scopes for c in S.SCOPES[s].columns)
    having = f" HAVING max(CASE WHEN ROUND = '{keep_from}' THEN 1 ELSE 0 END) = 1" if keep_from else ""
    listed = ", ".join(f"'{r}'" for r in rounds)
    return (start or with_(RAW, RESP, POOL, score_ctes(scopes, src, ("ROUND",)))) + f"""SELECT AC_ID, PC_ID, N_PARTY, RES1,
  {attrs}, {cols} FROM scored WHERE ROUND IN ({listed}) GROUP BY 1, 2, 3, 4{having}"""


ORACLE["combine_rounds_wide"] = wide(ALL, ["BC", "EP", "PP", "COM"], "pool")
ORACLE["combine_rounds_wide_from_bc"] = wide(ALL, ["BC", "EP", "PP"], "resp", "BC")

# ---- counts and ranking ------------------------------------------------------------------

for _n, _s in S.SCOPES.items():
    _k = ", ".join(_s.keys)
    ORACLE[f"score_counts_{_n}"] = BASE + f"SELECT {_k}, RES1, count(DN) AS {_s.count} FROM resp GROUP BY {_k}, RES1"
    ORACLE[f"score_scope_{_n}"] = scored([_n])
ORACLE["score_counts_date"] = BASE + """SELECT AC_ID, CAST(Start_Time AS DATE) AS Start_Time, RES1,
  count(DN) AS RES_DATEWISE FROM resp GROUP BY 1, 2, 3"""
ORACLE["score_counts_region"] = with_(RAW, RESP, *REGIONS) + """SELECT r.AC_ID, REGION, RES1,
  count(DN) AS RES_REGIONWISE_AC FROM resp r LEFT JOIN region_ac g ON r.AC_ID = g.AC_ID GROUP BY 1, 2, 3"""
ORACLE["score_pct"] = one_scope(
    "seq_pc", "SELECT PC_ID, N_PARTY, RES1, RES_SEQWISE_PC, SEQ_WISE_PERCENTAGE_PC FROM m_seq_pc")
ORACLE["score_max_pct"] = one_scope("ac", "SELECT DISTINCT AC_ID, MAX_PER_ACWISE FROM m_ac")
ORACLE["score_winner"] = one_scope("seq_ac", "SELECT DISTINCT AC_ID, N_PARTY, WINNER_SEQWISE_AC FROM m_seq_ac")
ORACLE["score_winner_draw"] = one_scope(
    "seq_ac", "SELECT DISTINCT AC_ID, N_PARTY, WINNER_SEQWISE_AC FROM m_seq_ac", tie="draw")
ORACLE["score_runner_up"] = one_scope("ac", """SELECT DISTINCT AC_ID, RUNNER_UP_ACWISE, "2ND_PER_ACWISE" FROM m_ac
  WHERE RUNNER_UP_ACWISE IS NOT NULL""")
_DENSE = """SELECT {k}, RES1, {p} AS p, dense_rank() OVER (PARTITION BY {k} ORDER BY {p} DESC) AS d FROM m_{n}"""
ORACLE["score_runner_up_dense"] = one_scope("seq_ac", f"""SELECT AC_ID, N_PARTY, RES1 AS RUNNER_UP_SEQWISE_AC,
  p AS "2ND_PER_SEQWISE_AC"
  FROM ({_DENSE.format(k='AC_ID, N_PARTY', p='SEQ_WISE_PERCENTAGE_AC', n='seq_ac')}) WHERE d = 2""")
ORACLE["score_scope_dense"] = scored(["ac"], f"""SELECT {', '.join('s.' + c for c in S.SCORE_KEYS)}, RES_ACWISE,
  AC_WISE_PERCENTAGE, MAX_PER_ACWISE, WINNER_ACWISE, p AS "2ND_PER_ACWISE", u AS RUNNER_UP_ACWISE, m AS MARGIN_ACWISE,
  {_band('m')} AS MARGIN_GROUP_ACWISE, WINNER_ACWISE || ' ' || CAST(m AS VARCHAR) || ' (' || u || ')' AS SUMMERY_ACWISE
  FROM (SELECT s.*, d.RES1 AS u, d.p, CAST(round(MAX_PER_ACWISE * 100) - round(d.p * 100) AS DOUBLE) / 100.0::DOUBLE AS m
    FROM scored s LEFT JOIN (SELECT * FROM ({_DENSE.format(k='AC_ID', p='AC_WISE_PERCENTAGE', n='ac')}) WHERE d = 2) d
    ON s.AC_ID = d.AC_ID) s""")
_S = S.SCOPES["seq_pc"]
ORACLE["score_rounds_dense"] = with_(RAW, RESP, POOL, score_ctes(["seq_pc"], "pool", ("ROUND",))) + f"""
  SELECT {', '.join('s.' + c for c in S.SCORE_KEYS)}, "{_S.count}", "{_S.pct}", "{_S.max_pct}", "{_S.winner}",
    s.p AS "{_S.second}", u AS "{_S.runner_up}", m AS "{_S.margin}", {_band('m')} AS "{_S.band}",
    "{_S.winner}" || ' ' || CAST(m AS VARCHAR) || ' (' || u || ')' AS "{_S.summary}", ROUND
  FROM (SELECT s.*, d.RES1 AS u, d.p, CAST(round("{_S.max_pct}" * 100) - round(d.p * 100) AS DOUBLE) / 100.0::DOUBLE AS m
    FROM scored s LEFT JOIN (SELECT * FROM ({_DENSE.format(k='ROUND, PC_ID, N_PARTY', p=_S.pct, n='seq_pc')}) WHERE d = 2) d
    ON s.ROUND = d.ROUND AND s.PC_ID = d.PC_ID AND s.N_PARTY = d.N_PARTY) s"""
ORACLE["score_margin"] = one_scope("seq_pc", """SELECT DISTINCT PC_ID, N_PARTY, MAX_PER_SEQWISE_PC,
  "2ND_PER_SEQWISE_PC", MARGIN_SEQWISE_PC FROM m_seq_pc""")
ORACLE["margin_bucket"] = one_scope(
    "seq_ac", "SELECT AC_ID, N_PARTY, RES1, MARGIN_SEQWISE_AC, MARGIN_GROUP_SEQWISE_AC FROM m_seq_ac")
ORACLE["score_summary"] = one_scope("ac", "SELECT AC_ID, RES1, SUMMERY_ACWISE FROM m_ac")
ORACLE["score_all"] = scored(ALL)

# ---- unions and rounds -------------------------------------------------------------------

ORACLE["union_branches"] = W + f"""SELECT CALL_ID, Campaign_Name, PC_NO FROM raw WHERE Campaign_Name LIKE '%-LSE'
  UNION ALL SELECT CALL_ID, Campaign_Name, PC_NO FROM raw WHERE Campaign_Name LIKE 'R1-%'
  UNION ALL SELECT CALL_ID, Campaign_Name, PC_NO FROM raw WHERE PC_NO IN ({_NUMS})"""
ORACLE["pool_rounds"] = BASE + f"SELECT {', '.join(S.CANONICAL_COLUMNS)} FROM resp"
ORACLE["stack_rounds"] = scored(ALL, src="pool", by=("ROUND",), extra=(POOL,))

_CANON = ("DN, Start_Time, DTMF_REP, state, AC_ID, AC_NO, PC_ID, PC_NO, PART_NO, GENDER, AGE, N_PARTY, RES1, RES2, CASTE")


def colmax(where: str) -> str:
    cols = ["VENDOR_ID", "Start_Time", "DTMF_REP", "PARTY", "N_PARTY", "AC_NO", "PC_NO", "PART_NO", "GENDER", "AGE",
            "state", "CASTE"]
    return (f"SELECT DN, max({CODE}) AS STATE_CODE, {', '.join(f'max({c}) AS {c}' for c in cols)} "
            f"FROM raw WHERE {VALID} AND {where} GROUP BY DN")


def bc_branch(state, where, vendors, later, geo="semi", rules=()) -> str:
    ids = "STATE_CODE || '-AC-' || AC_NO AS AC_ID, STATE_CODE || '-' || PC_NO AS PC_ID"
    inner = f"""SELECT * EXCLUDE (N_PARTY), {vendor_case(vendors)} AS N_PARTY, {ids} FROM ({colmax(where)})"""
    inner = f"""SELECT *, {case_first(MAIN)} AS RES1, {case_later(MAIN) if later else "''"} AS RES2 FROM ({inner})"""
    if geo == "semi":
        inner = f"SELECT * FROM ({inner}) WHERE AC_NO IN (SELECT AC_NO FROM geo WHERE State_Code = '{state}')"
    else:
        inner = f"""SELECT t.* EXCLUDE (PC_NO, PC_ID), b.PC_No AS PC_NO, b.State_Code || '-' || b.PC_No AS PC_ID
          FROM ({inner}) t JOIN (SELECT DISTINCT * FROM remap WHERE State_Code = '{state}') b ON t.AC_NO = b.AC_NO"""
    if rules:
        inner = f"SELECT * REPLACE ({recode_case(rules)} AS RES1) FROM ({inner}) WHERE RES1 IS NOT NULL"
    return f"SELECT {_CANON} FROM ({inner}) WHERE RES1 IS NOT NULL"


def bc_state(s: str) -> list[str]:
    name = "AND state ILIKE 'a%'" if s < "R3" else ""
    pm = f"Campaign_Name LIKE '{s}-BC-PC%-PM%' AND Q2_Type = 'PM_2024'"
    return [
        bc_branch(s, f"Campaign_Name LIKE '{s}-BC-PC%-LSE' AND Q2_Type = 'LSE_2019' {name}", A.VENDORS, True,
                  "remap" if s == "R1" else "semi"),
        bc_branch(s, f"{pm} AND PC_NO IN ({_NUMS})", A.VENDORS_PM, True, rules=A.recodes(s)),
        bc_branch(s, f"{pm} AND PC_NO NOT IN ({_NUMS})", A.VENDORS_PM, False, rules=A.recodes(s)),
    ]


def latest(where: str, branch: str, later=False, seq="N_PARTY") -> str:
    """Latest call per number of one branch, decoded; timestamps kept for a second pass."""
    ids = f"{CODE} || '-AC-' || AC_NO AS AC_ID, {CODE} || '-' || PC_NO AS PC_ID"
    return f"""SELECT * EXCLUDE (rn, N_PARTY), {seq} AS N_PARTY, '{branch}' AS branch FROM (
      SELECT *, {ids}, {case_first(MAIN, seq)} AS RES1, {case_later(MAIN, seq) if later else "''"} AS RES2,
      {_LATEST.format('DN')} FROM raw WHERE {where}) WHERE rn = 1 AND RES1 IS NOT NULL"""


def again(rows: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY DN ORDER BY Start_Time DESC, branch DESC) AS again
      FROM ({rows})) WHERE again = 1"""


_DAY = _CANON.replace("Start_Time", "CAST(Start_Time AS DATE) AS Start_Time")


def ep_state(s: str) -> str:
    rows = " UNION ALL ".join([
        latest(f"Campaign_Name LIKE '{s}-EP%' AND Start_Time < TIMESTAMP '1998-06-01'", f"ep_{s}_a"),
        latest(f"Campaign_Name LIKE '{s}-EP%' AND Start_Time >= TIMESTAMP '1998-06-01'", f"ep_{s}_b"),
    ])
    return f"SELECT {_DAY} FROM ({again(rows) if s in ('R0', 'R2') else rows})"


def pp_state(s: str) -> str:
    hidden = latest(f"Campaign_Name LIKE '{s}-PP%' AND PC_NO IN ({_NUMS}) AND Start_Time >= TIMESTAMP '2000-01-01'", "h")
    a = latest(f"""(Campaign_Name LIKE '{s}-PP%-LSE' OR Campaign_Name LIKE '{s}-PP-AC%')
      AND PC_NO IN ({_NUMS})""", f"pp_{s}_a", later=True)
    b = latest(f"""Campaign_Name LIKE '{s}-PP%' AND Campaign_Name NOT LIKE '{s}-PP-AC%'
      AND PC_NO NOT IN ({_NUMS})""", f"pp_{s}_b")
    rows = f"""SELECT * FROM ({a}) t WHERE NOT EXISTS (SELECT 1 FROM ({hidden}) x WHERE x.DN = t.DN)
      UNION ALL SELECT * FROM ({b}) WHERE Start_Time < TIMESTAMP '2001-01-01'"""
    return f"SELECT {_DAY} FROM ({again(rows)})"


ORACLE["round_bc"] = with_(RAW, GEO, REMAP) + "\nUNION ALL\n".join(b for s in A.STATES for b in bc_state(s))
ORACLE["round_by_branch"] = ORACLE["round_bc"]
ORACLE["round_ep"] = W + "\nUNION ALL\n".join(ep_state(s) for s in A.STATES)
ORACLE["round_pp"] = W + "\nUNION ALL\n".join(pp_state(s) for s in A.STATES)
ORACLE["round_pp_party"] = W + "\nUNION ALL\n".join(
    f"""SELECT {_CANON} FROM (SELECT *, STATE_CODE || '-AC-' || AC_NO AS AC_ID, STATE_CODE || '-' || PC_NO AS PC_ID,
      {case_first(MAIN)} AS RES1, {case_later(MAIN)} AS RES2
      FROM ({colmax(f"Campaign_Name LIKE '{s}-PP-%' AND Start_Time >= TIMESTAMP '1995-06-01'")}))
      WHERE RES1 IS NOT NULL"""
    for s in A.STATES
)
ORACLE["round_bc_from_tables"] = ORACLE["round_bc"]
_EP_DATES = "Campaign_Name LIKE 'R_-EP%' AND Start_Time >= TIMESTAMP '{}' AND Start_Time < TIMESTAMP '{}'"
ORACLE["round_unpadded_dates"] = W + f"SELECT {_CANON}, 'EP' AS ROUND FROM (" + " UNION ALL ".join([
    latest(_EP_DATES.format("1996-09-05", "1997-10-01"), "d_a"), latest(_EP_DATES.format("1996-10-01", "1997-09-30"), "d_b"),
]) + ")"
ORACLE["round_overlap"] = W + f"SELECT {_CANON}, 'EP' AS ROUND FROM (" + " UNION ALL ".join([
    latest("Campaign_Name LIKE 'R_-EP%'", "o_all"),
    latest("Campaign_Name LIKE 'R_-EP-PC%' AND Start_Time <= TIMESTAMP '1997-01-01'", "o_early"),
    latest("Campaign_Name LIKE 'R_-EP%-PM'", "o_party", seq="PARTY"),
]) + ")"

# ---- ready rounds: states, dates, keys and labels written out by hand --------------------------

PRESET = """calls AS MATERIALIZED (
  SELECT * REPLACE (
    CASE substr(Campaign_Name, 1, 2) WHEN 'R0' THEN 'AP' WHEN 'R1' THEN 'OD' WHEN 'R2' THEN 'UP' WHEN 'R3' THEN 'PB' ELSE 'DL' END
      || substr(Campaign_Name, 3) AS Campaign_Name,
    CASE substr(Campaign_Name, 1, 2) WHEN 'R0' THEN 'Andhra Pradesh' WHEN 'R1' THEN 'Odisha' WHEN 'R2' THEN 'UTTAR PRADESH'
      WHEN 'R3' THEN 'Punjab' ELSE 'Delhi' END AS state,
    CASE substr(Campaign_Name, 1, 2) || N_PARTY
      WHEN 'R0ABCDO' THEN 'TYIO' WHEN 'R0BCDAO' THEN 'YTIO' WHEN 'R0CDABO' THEN 'BIO' WHEN 'R0DABCO' THEN 'IBO' WHEN 'R0BAO' THEN 'TYO'
      WHEN 'R1ABCDO' THEN 'BDIO' WHEN 'R1BCDAO' THEN 'DBIO' WHEN 'R1CDABO' THEN 'BDO' WHEN 'R1DABCO' THEN 'DBO' WHEN 'R1BAO' THEN 'IBO'
      WHEN 'R2ABCDO' THEN 'BSO' WHEN 'R2BCDAO' THEN 'SBO' WHEN 'R2CDABO' THEN 'BSMO' WHEN 'R2DABCO' THEN 'SBMO' WHEN 'R2BAO' THEN 'XBO'
      WHEN 'R3ABCDO' THEN 'ABIO' WHEN 'R3BCDAO' THEN 'BAIO' WHEN 'R3CDABO' THEN 'AIO' WHEN 'R3DABCO' THEN 'IAO' WHEN 'R3BAO' THEN 'DBAO'
      WHEN 'R4ABCDO' THEN 'ABO' WHEN 'R4BCDAO' THEN 'BAO' WHEN 'R4CDABO' THEN 'ABIO' WHEN 'R4DABCO' THEN 'BIAO' WHEN 'R4BAO' THEN 'IBO' END AS N_PARTY,
    CAST(DATE '2024-04-10' + CAST(CALL_ID % 60 AS INTEGER) AS TIMESTAMP) AS Start_Time,
    CASE WHEN CALL_ID % 2 = 0 THEN translate(DTMF_REP, '12345', '34567') ELSE translate(DTMF_REP, '12345', '56789') END AS DTMF_REP)
  FROM raw)"""
_AP = "TYIO: 5 TDP+, 6 YSRCP, 7 INC, 8 OTHERS; YTIO: 5 YSRCP, 6 TDP+, 7 INC, 8 OTHERS; BIO: 5 BJP, 6 INC, 8 OTHERS; " \
      "IBO: 5 INC, 6 BJP, 8 OTHERS; TYO: 5 TDP+, 6 YSRCP, 8 OTHERS"
_OD5 = "BDIO: 5 BJP, 6 BJD, 7 INC, 8 OTHERS; DBIO: 5 BJD, 6 BJP, 7 INC, 8 OTHERS; BDO: 5 BJP, 6 BJD, 8 OTHERS; " \
       "DBO: 5 BJD, 6 BJP, 8 OTHERS; IBO: 5 INC, 6 BJP, 8 OTHERS"
_OD3 = "BDIO: 3 BJP, 4 BJD, 5 INC, 6 OTHERS; DBIO: 3 BJD, 4 BJP, 5 INC, 6 OTHERS; BDO: 3 BJP, 4 BJD, 6 OTHERS; " \
       "DBO: 3 BJD, 4 BJP, 6 OTHERS; IBO: 3 INC, 4 BJP, 6 OTHERS"
_OD_SECOND = "BDIO: 5 BJP, 6 BJD, 7 INC, 8 OTHERS; DBIO: 5 BJD, 6 BJP, 7 INC, 8 OTHERS"
_UP = "BSO: 5 BJP, 6 SP, 8 OTHERS; SBO: 5 SP, 6 BJP, 8 OTHERS; BSMO: 5 BJP, 6 SP, 7 BSP, 8 OTHERS; " \
      "SBMO: 5 SP, 6 BJP, 7 BSP, 8 OTHERS; XBO: 6 BJP, 8 OTHERS"
_PB5 = "ABIO: 5 AAP, 6 BJP, 7 INC, 8 OTHERS; BAIO: 5 BJP, 6 AAP, 7 INC, 8 OTHERS; AIO: 5 AAP, 6 INC, 8 OTHERS; " \
       "IAO: 5 INC, 6 AAP, 8 OTHERS; DBAO: 5 SAD(A), 6 BJP, 7 AAP, 8 OTHERS"
_PB3 = "ABIO: 3 AAP, 4 BJP, 5 INC, 6 OTHERS; BAIO: 3 BJP, 4 AAP, 5 INC, 6 OTHERS; AIO: 3 AAP, 4 INC, 6 OTHERS; " \
       "IAO: 3 INC, 4 AAP, 6 OTHERS; DBAO: 3 SAD(A), 4 BJP, 5 AAP, 6 OTHERS"
_DL5 = "ABO: 5 AAP, 6 BJP, 8 OTHERS; BAO: 5 BJP, 6 AAP, 8 OTHERS; ABIO: 5 AAP, 6 BJP, 7 INC, 8 OTHERS; " \
       "BIAO: 5 BJP, 6 INC, 7 AAP, 8 OTHERS; IBO: 5 INC, 6 BJP, 8 OTHERS"
_DL3 = "ABO: 3 AAP, 4 BJP, 6 OTHERS; BAO: 3 BJP, 4 AAP, 6 OTHERS; ABIO: 3 AAP, 4 BJP, 5 INC, 6 OTHERS; " \
       "BIAO: 3 BJP, 4 INC, 5 AAP, 6 OTHERS; IBO: 3 INC, 4 BJP, 6 OTHERS"


def keys(text: str, position: int = 1) -> list[Arm]:
    return [Arm(position, code.strip(), *key.split()) for part in text.split(";")
            for code, listed in [part.split(":")] for key in listed.split(",")]


def ready(where: str, branch: str, labels: str, second: str = "") -> str:
    ids = f"{CODE} || '-AC-' || AC_NO AS AC_ID, {CODE} || '-' || PC_NO AS PC_ID"
    later = case_later(keys(second, 2)) if second else "''"
    return f"""SELECT * EXCLUDE (rn), '{branch}' AS branch FROM (SELECT *, {ids}, {case_first(keys(labels))} AS RES1,
      {later} AS RES2, {_LATEST.format('DN')} FROM calls WHERE {where}) WHERE rn = 1 AND RES1 IS NOT NULL"""


def days(start=None, end=None) -> str:
    return " AND ".join([f"Start_Time >= TIMESTAMP '{start}'"] * bool(start) + [f"Start_Time < TIMESTAMP '{end}'"] * bool(end))


def once(*parts: str) -> str:
    return f"SELECT {_DAY} FROM ({again(' UNION ALL '.join(parts)) if len(parts) > 1 else parts[0]})"


_EP = "Campaign_Name LIKE '{}-EP%'"
ORACLE["preset_ep"] = with_(RAW, PRESET) + "\nUNION ALL\n".join([
    once(ready(_EP.format("AP"), "ep_ap_0", _AP)),
    once(ready(_EP.format("DL"), "ep_dl_0", _DL3)),
    once(ready(f"{_EP.format('OD')} AND {days('2024-04-19', '2024-06-01')}", "ep_od_0", _OD5),
         ready(f"{_EP.format('OD')} AND {days('2024-06-01')}", "ep_od_1", _OD3)),
    once(ready(f"{_EP.format('PB')} AND {days('2024-04-19')} AND PC_NO <> 12", "ep_pb_0", _PB3),
         ready(f"{_EP.format('PB')} AND {days('2024-04-19')} AND PC_NO = 12", "ep_pb_1", _PB3)),
    once(ready(f"{_EP.format('UP')} AND {days('2024-04-19')}", "ep_up_0", _UP),
         ready(f"{_EP.format('UP')} AND {days('2024-05-20')}", "ep_up_1", _UP)),
])
_PB_CALLS = "(Campaign_Name LIKE 'PB-PP%' OR Campaign_Name LIKE 'PB-AC%')"
_UP_WHERE = f"Campaign_Name LIKE 'UP-PP-%' AND state ILIKE 'uttar%' AND {days('2024-04-05')}"
ORACLE["preset_pp"] = with_(RAW, PRESET) + "\nUNION ALL\n".join([
    once(ready("Campaign_Name LIKE 'AP-PP%'", "pp_ap_0", _AP)),
    once(ready(f"Campaign_Name LIKE 'DL-PP%' AND {days(end='2024-05-23')}", "pp_dl_0", _DL5),
         ready(f"Campaign_Name LIKE 'DL-PP%' AND {days('2024-05-23')}", "pp_dl_1", _DL3)),
    once(ready("Campaign_Name LIKE 'OD-PP%' AND PC_NO = 17", "pp_od_0", _OD5, _OD_SECOND),
         ready("Campaign_Name LIKE 'OD-PP%' AND PC_NO <> 17", "pp_od_1", _OD5)),
    once(ready(f"{_PB_CALLS} AND {days(end='2024-05-21')} AND PC_NO <> 12", "pp_pb_0", _PB5),
         ready(f"{_PB_CALLS} AND {days(end='2024-05-21')} AND PC_NO = 12", "pp_pb_1", _PB5),
         ready(f"{_PB_CALLS} AND {days('2024-05-21')} AND PC_NO = 7", "pp_pb_2", _PB3),
         ready(f"{_PB_CALLS} AND {days('2024-05-29')} AND PC_NO IN (6, 8)", "pp_pb_3", _PB5)),
    f"""SELECT {_CANON} FROM (SELECT *, STATE_CODE || '-AC-' || AC_NO AS AC_ID, STATE_CODE || '-' || PC_NO AS PC_ID,
      {case_first(keys(_UP))} AS RES1, '' AS RES2 FROM ({colmax(_UP_WHERE).replace('FROM raw', 'FROM calls')}))
      WHERE RES1 IS NOT NULL AND PC_NO NOT IN (37, 79, 80)""",
])

_WITH_REGION = "SELECT s.*, REGION FROM {} s LEFT JOIN region_ac g ON s.AC_ID = g.AC_ID"
ORACLE["round_com"] = scored(ALL, "SELECT *, 'COM' AS ROUND FROM (" + _WITH_REGION.format("scored") + ")", extra=REGIONS)
ORACLE["all_rounds_long"] = scored(ALL, _WITH_REGION.format("scored"), "pool", ("ROUND",), (POOL, *REGIONS))

_BUILT = " UNION ALL ".join([
    "SELECT *, 'BC' AS ROUND FROM (" + " UNION ALL ".join(b for s in A.STATES for b in bc_state(s)) + ")",
    "SELECT *, 'EP' AS ROUND FROM (" + " UNION ALL ".join(ep_state(s) for s in A.STATES) + ")",
    "SELECT *, 'PP' AS ROUND FROM (" + " UNION ALL ".join(pp_state(s) for s in A.STATES) + ")",
])
ORACLE["run_all_states"] = with_(
    RAW, GEO, REMAP, *REGIONS, f"resp AS (SELECT * FROM ({_BUILT}))", POOL, score_ctes(ALL, "pool", ("ROUND",))
) + _WITH_REGION.format("scored")

ORACLE["run_incremental"] = ORACLE["run_by_number"] = ORACLE["run_all_states"]

ORACLE["run_wide_all_scopes"] = wide(ALL, ["BC", "EP", "PP", "COM"], "pool", start=with_(
    RAW, GEO, REMAP, f"resp AS (SELECT * FROM ({_BUILT}))", POOL, score_ctes(ALL, "pool", ("ROUND",))))

# ---- report ------------------------------------------------------------------------------

ORACLE["report_total"] = LONG + "SELECT count(*) AS total_rows FROM scored"
ORACLE["report_distinct"] = LONG + """SELECT DISTINCT 'state' AS kind, state AS value FROM scored
  WHERE state IS NOT NULL UNION ALL SELECT DISTINCT 'RES1', RES1 FROM scored WHERE RES1 IS NOT NULL
  UNION ALL SELECT DISTINCT 'AC_NO', CAST(AC_NO AS VARCHAR) FROM scored WHERE state = 'ASIA' AND AC_NO IS NOT NULL"""
ORACLE["report_sort"] = LONG + "SELECT * FROM scored ORDER BY state, AC_NO, RES1, ROUND, PC_ID, AC_ID, N_PARTY"
ORACLE["report_page"] = LONG + """SELECT * FROM scored WHERE ROUND = 'COM'
  ORDER BY state NULLS LAST, AC_NO NULLS LAST, RES1, ROUND, PC_ID NULLS LAST, AC_ID NULLS LAST, N_PARTY
  LIMIT 30 OFFSET 60"""
ORACLE["report_slice"] = LONG + "SELECT * FROM scored WHERE state = 'EUROPE' AND AC_NO = 37"
ORACLE["report_full"] = LONG + """, chosen AS (SELECT * FROM scored WHERE state = 'ASIA' AND ROUND = 'BC'),
  counts AS (SELECT count(*) AS total, CAST(ceil(count(*) / 30.0) AS INTEGER) AS pages,
    (SELECT count(DISTINCT state) FROM scored) AS n_states, count(DISTINCT AC_NO) AS n_ac_numbers,
    count(DISTINCT RES1) AS n_parties FROM chosen)
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (ORDER BY state NULLS LAST, AC_NO NULLS LAST, RES1, ROUND,
    PC_ID NULLS LAST, AC_ID NULLS LAST, N_PARTY) AS place FROM chosen), counts
  WHERE place > 30 * (least(2, pages) - 1) AND place <= 30 * least(2, pages)"""

# ---- many branches, time, levels -----------------------------------------------------------

ORACLE["match_stored_branches"] = with_(RAW, """branches AS (
  SELECT 'S' || s_suppkey AS branch_id, n_nationkey AS pc, s_suppkey AS k, 'R' || n_regionkey AS r,
    CASE s_suppkey % 3 WHEN 0 THEN 'BC' WHEN 1 THEN 'EP' ELSE 'PP' END AS round
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""") + """
SELECT branch_id, count(*) AS n_calls, min(CALL_ID) AS first_call
FROM raw JOIN branches ON (Campaign_Name LIKE r || '-' || round || '-PC' || pc || '-%'
    OR (k % 4 = 0 AND Campaign_Name LIKE r || '-%-PM') OR (k % 4 = 1 AND Campaign_Name LIKE '%-PC7-LSE'))
  AND (k % 5 <> 0 OR NOT Campaign_Name LIKE '%-PC1%') AND (k % 7 <> 0 OR state ILIKE 'a%')
  AND (k % 6 <> 0 OR Q2_Type = 'LSE_2019') AND (k % 8 <> 0 OR Start_Time >= TIMESTAMP '1995-01-01')
  AND (k % 9 <> 0 OR Start_Time < TIMESTAMP '1997-06-01')
  AND (k % 10 <> 0 OR PC_NO IN (pc, 3)) AND (k % 11 <> 0 OR PC_NO <> pc)
GROUP BY branch_id"""

ORACLE["calls_in_windows"] = with_(RAW, """windows AS (
  SELECT s_suppkey AS window_id, s_nationkey AS pc, DATE '1992-01-01' + CAST(s_suppkey * 37 % 2300 AS INTEGER) AS opens,
    CASE WHEN s_suppkey % 10 <> 0 THEN DATE '1992-01-01' + CAST(s_suppkey * 37 % 2300 + pow(3, s_suppkey % 7) AS INTEGER) END AS closes
  FROM supplier)""") + """
SELECT window_id, count(*) AS n_calls, max(CALL_ID) AS last_call
FROM raw JOIN windows ON PC_NO = pc AND Start_Time >= opens AND (closes IS NULL OR Start_Time < closes) GROUP BY window_id"""

ORACLE["schedule_in_force"] = with_(RAW, """schedules AS (
  SELECT s_nationkey AS pc, DATE '1992-01-01' + CAST(s_suppkey * 53 % 120 * 20 AS INTEGER) AS valid_from,
    s_suppkey AS schedule_id, s_acctbal AS budget FROM supplier)""") + """
SELECT CALL_ID, PC_NO AS pc, Start_Time, CAST(valid_from AS TIMESTAMP) AS valid_from, schedule_id, budget
FROM raw LEFT JOIN schedules s ON s.pc = PC_NO AND valid_from <= Start_Time
QUALIFY row_number() OVER (PARTITION BY CALL_ID ORDER BY valid_from DESC NULLS LAST, schedule_id DESC) = 1"""

ORACLE["call_sessions"] = """
WITH cut AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new
  FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM cut)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS attempts,
  min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_answer,
  (epoch_us(min(CASE WHEN event_type = 'purchase' THEN ts END)) - epoch_us(min(ts))) / 1000000.0 AS seconds_to_answer
FROM numbered GROUP BY user_id, s"""

_LEVELS = {"state": "state", "pc": "state, PC_ID", "ac": "state, PC_ID, AC_ID", "ordering": "state, PC_ID, AC_ID, N_PARTY", "all": ""}
ORACLE["distinct_respondents"] = with_(RAW, RESP) + " UNION ALL ".join(
    f"""SELECT '{name}' AS level, {', '.join(c if c in keys.split(', ') else f'NULL AS {c}' for c in ('state', 'PC_ID', 'AC_ID', 'N_PARTY'))},
    count(DISTINCT DN) AS respondents FROM resp {'GROUP BY ' + keys if keys else ''}""" for name, keys in _LEVELS.items())

_CALL_LEVELS = {"ac": "state, PC_NO, AC_NO", "pc": "state, PC_NO", "state": "state", "all": ""}
ORACLE["duration_percentiles"] = with_(RAW, """timed AS (
  SELECT raw.*, o_totalprice / 10 AS duration FROM raw JOIN orders ON o_orderkey = CALL_ID WHERE o_orderkey % 31 <> 0)""") + " UNION ALL ".join(
    f"""SELECT '{name}' AS level, {', '.join(c if c in keys.split(', ') else f'NULL AS {c}' for c in ('state', 'PC_NO', 'AC_NO'))},
    count(*) AS n, quantile_disc(duration, 0.5) AS p50, quantile_disc(duration, 0.9) AS p90, quantile_disc(duration, 0.99) AS p99
    FROM timed {'GROUP BY ' + keys if keys else ''}""" for name, keys in _CALL_LEVELS.items())

# ---- stored and streamed -------------------------------------------------------------------

ORACLE["answers_of_two_rounds"] = with_(RAW, RESP) + """
SELECT b.state AS state, e.state AS state_ep, b.RES1 AS answer_bc, e.RES1 AS answer_ep, count(*) AS numbers
FROM resp b JOIN resp e ON b.DN = e.DN AND b.ROUND = 'BC' AND e.ROUND = 'EP' GROUP BY ALL"""

_VOTES = "SELECT AC_ID, PC_ID, N_PARTY, RES1, state, ROUND, count(DN) AS votes FROM resp {} GROUP BY ALL"
ORACLE["compare_two_runs"] = with_(RAW, RESP, f"old AS ({_VOTES.format('')})", """new AS (
  SELECT AC_ID, PC_ID, N_PARTY, RES1, state, ROUND, count(DN) AS votes FROM resp
  WHERE coalesce(NOT (state = 'EUROPE' AND AGE % 7 = 0), false) GROUP BY ALL)""", """diff AS (
  SELECT *, -1 AS n FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
  UNION ALL SELECT *, 1 AS n FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old))""") + """
SELECT * EXCLUDE n, CAST(n AS BIGINT) AS n, CASE WHEN min(n) OVER k * max(n) OVER k < 0 THEN 'changed' WHEN n > 0 THEN 'added' ELSE 'removed' END AS change
FROM diff WINDOW k AS (PARTITION BY AC_ID, PC_ID, N_PARTY, RES1, ROUND)"""

ORACLE["stream_windows"] = """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events WHERE ts IS NOT NULL GROUP BY ALL"""
