"""Survey tables derived from the provided order tables.

Each order is a call: the customer is the number called, the priority the first key pressed, the
market segment the ordering of the question. The geography comes from the suppliers, so some
constituencies are missing from it and others occur several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore import Arm, Branch, Codebook, Recode, Registry, Spelling, StateRoundSpec
from surveyscore.plans.rounds import build_rounds
from surveyscore.plans.spec import BRANCH_TABLE, branch_rows, read_registry
from surveyscore.sources.sinks import materialise

RAW_COLUMNS = [
    "o_orderkey AS CALL_ID",
    "CASE WHEN o_orderkey % 251 = 0 THEN NULL ELSE cast(o_custkey AS string) END AS DN",
    "concat('R', n_regionkey, '-', CASE o_orderstatus WHEN 'F' THEN 'BC' WHEN 'O' THEN 'EP' ELSE 'PP' END,"
    " '-PC', n_nationkey, CASE WHEN o_orderkey % 2 = 0 THEN '-LSE' ELSE '-PM' END) AS Campaign_Name",
    "cast(o_orderkey % 12 + 1 AS int) AS VENDOR_ID",
    "concat('V', o_orderkey % 12 + 1) AS VENDOR",
    "'ANSWERED' AS CALL_STATUS",
    "o_orderdate AS Start_Time",
    "cast(o_orderkey % 120 AS int) AS Call_Duration_Sec_",
    # answers: none, empty, separators only, one key, a two-digit key, two keys, three keys
    "CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''"
    " WHEN o_orderkey % 97 = 0 THEN ',,' WHEN o_orderkey % 7 = 0 THEN left(o_orderpriority, 1)"
    " WHEN o_orderkey % 13 = 0 THEN concat(left(o_orderpriority, 1), o_orderkey % 5 + 1)"
    " WHEN o_orderkey % 3 = 0 THEN concat(left(o_orderpriority, 1), ',', o_orderkey % 5 + 1)"
    " ELSE concat(left(o_orderpriority, 1), ',', o_orderkey % 5 + 1, ',', (o_orderkey + 2) % 5 + 1)"
    " END AS DTMF_REP",
    "CASE WHEN o_totalprice >= 250000 THEN 'ABCDO' ELSE 'BAO' END AS PARTY",
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ABCDO' WHEN 'BUILDING' THEN 'BCDAO'"
    " WHEN 'FURNITURE' THEN 'CDABO' WHEN 'HOUSEHOLD' THEN 'DABCO' ELSE 'BAO' END AS N_PARTY",
    "cast(CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE n_nationkey % 18 * 10 + c_custkey % 10 END AS int) AS AC_NO",
    "n_nationkey AS PC_NO",
    "cast(o_custkey % 30 AS string) AS PART_NO",
    "'-' AS EPIC_NO",
    "'-' AS POLLING_STATION_ADDRESS",
    "CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS GENDER",
    "cast(18 + o_custkey % 60 AS int) AS AGE",
    "concat('C', o_custkey % 4) AS CASTE",
    "r_name AS state",
    "CASE WHEN o_orderkey % 2 = 0 THEN 'LSE_2019' ELSE 'PM_2024' END AS Q2_Type",
]

ROUNDS = ("BC", "EP", "PP")
STATES = ("R0", "R1", "R2", "R3", "R4")


# Declared, so that no job reads file footers just to learn the columns.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region = (
        table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region")
    )
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    return joined.selectExpr(*RAW_COLUMNS)


def _supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


_STATE = "concat('R', n_regionkey) AS State_Code"
_AC = "cast(n_nationkey % 18 * 10 + s_suppkey % 10 AS int) AS AC_NO"  # starts anew in each state


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_nation(spark, sf_dir).selectExpr(_STATE, _AC)


def geo_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    pc = "cast(n_nationkey * 2 + (s_suppkey % 10) div 5 AS int) AS PC_No"
    return _supplier_nation(spark, sf_dir).selectExpr(_STATE, _AC, pc)


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_nation(spark, sf_dir).selectExpr(
        _STATE, _AC, "concat('R', n_regionkey, '-', n_nationkey) AS PC_ID",
        "concat(r_name, CASE WHEN s_suppkey % 10 < 5 THEN ' NORTH' ELSE ' SOUTH' END) AS PC_REGION",
    )


# ---- rules -------------------------------------------------------------------------------

LETTERS = {"A": "ALPHA", "B": "BRAVO", "C": "CHARLIE", "D": "DELTA", "O": "OTHERS"}
ORDERINGS = ("ABCDO", "BCDAO", "CDABO", "DABCO", "BAO")
SPELLING = Spelling(1, LETTERS)
LATER_DIGITS = ("3", "1", "2", "5", "4")  # arm order, on purpose not ascending


def later_arms() -> list[Arm]:
    """Second question: labels run backwards through the code."""
    return [
        Arm(2, code, d, LETTERS[code[-1 - (int(d) % len(code))]])
        for code in ORDERINGS for d in LATER_DIGITS
    ]


def mixed_arms() -> list[Arm]:
    """Arms of all three forms, with a repeat that is never reached."""
    out = []
    for code in ORDERINGS:
        out += [
            Arm(1, code, "1", f"{code}-more", "prefix"),
            Arm(1, code, "1", f"{code}-only", "exact"),
            Arm(1, code, "2", f"{code}-two"),
            Arm(1, code, "2", f"{code}-never"),
            Arm(1, code, "3", f"{code}-last", "exact"),
        ]
    return out


def books() -> Codebook:
    book = Codebook()
    book.add("main", SPELLING.arms(ORDERINGS)).add("main", later_arms())
    book.add("mixed", mixed_arms())
    return book


VENDORS = {"ABCDO": (1, 3, 7, 9, 10, 11), "BAO": ("4",), "BCDAO": ("2", "5")}
VENDORS_PM = {"DABCO": (2, 4, 6, 8, 10, 12), "CDABO": (1, 3)}
NUMBERS = (1, 3, 5, 8, 12, 17, 20)  # constituencies handled apart from the rest


def recodes(state: str) -> tuple[Recode, ...]:
    k = int(state[1:])
    return (
        Recode((f"{state}-{k}", f"{state}-{k + 5}"), ("ALPHA", "BRAVO"), "FRONT"),
        Recode((f"{state}-{k}",), ("BRAVO", "DELTA"), "UNION"),
    )


def registry() -> Registry:
    """Three rounds of five states, with the build patterns of the survey."""
    reg = Registry(books=books())
    for s in STATES:
        geo_mode = "remap" if s == "R1" else "semi"
        reg.add(StateRoundSpec(s, "BC", (
            Branch(f"bc_{s}_lse", (f"{s}-BC-PC%-LSE",), state_prefix="a%" if s < "R3" else None,
                   q2_type="LSE_2019", dedup="colmax", ordering="vendor", vendors=VENDORS,
                   book="main", later_keys=True, geo=geo_mode, geo_state=s),
            Branch(f"bc_{s}_pm_a", (f"{s}-BC-PC%-PM%",), q2_type="PM_2024", pc_in=NUMBERS,
                   dedup="colmax", ordering="vendor", vendors=VENDORS_PM, book="main",
                   later_keys=True, geo="semi", geo_state=s, recode=recodes(s)),
            Branch(f"bc_{s}_pm_b", (f"{s}-BC-PC%-PM%",), q2_type="PM_2024", pc_not_in=NUMBERS,
                   dedup="colmax", ordering="vendor", vendors=VENDORS_PM, book="main",
                   geo="semi", geo_state=s, recode=recodes(s)),
        )))
        reg.add(StateRoundSpec(s, "EP", (
            Branch(f"ep_{s}_a", (f"{s}-EP%",), end="1998-06-01", spelling=SPELLING),
            Branch(f"ep_{s}_b", (f"{s}-EP%",), start="1998-06-01", spelling=SPELLING),
        ), dedup_after_union=s in ("R0", "R2"), date_only=True))
        reg.add(StateRoundSpec(s, "PP", (
            Branch(f"pp_{s}_hidden", (f"{s}-PP%",), pc_in=NUMBERS, start="2000-01-01",
                   spelling=SPELLING, emit=False),
            Branch(f"pp_{s}_a", (f"{s}-PP%-LSE", f"{s}-PP-AC%"), pc_in=NUMBERS, book="main",
                   later_keys=True, exclude_numbers_of=f"pp_{s}_hidden"),
            Branch(f"pp_{s}_b", (f"{s}-PP%",), campaign_not_like=(f"{s}-PP-AC%",),
                   pc_not_in=NUMBERS, book="main", post_end="2001-01-01"),
        ), dedup_after_union=True, date_only=True))
    return reg


def stored_registry(spark: SparkSession) -> Registry:
    """The BC specs and their arms, written to tables and read back from them."""
    reg = registry()
    specs = [s for s in reg.select(reg.keys()) if s.round == "BC"]
    rows = [tuple(r[f.name] for f in schema_of(BRANCH_TABLE)) for r in branch_rows(specs)]
    table = materialise(spark.createDataFrame(rows, BRANCH_TABLE), "branches")
    return read_registry(table, materialise(reg.books.to_df(spark), "arms"))


def schema_of(ddl: str):
    return T.StructType.fromDDL(ddl).fields


def party_registry() -> Registry:
    """Round PP built by party collapse."""
    reg = Registry(books=books())
    for s in STATES:
        reg.add(StateRoundSpec(s, "PP", (
            Branch(f"pp_{s}_party", (f"{s}-PP-%",), start="1995-06-01", dedup="colmax",
                   book="main", later_keys=True),
        )))
    return reg


def plain_registry() -> Registry:
    """Every round by latest call, first key only: the input of the scoring queries."""
    reg = Registry()
    for r in ROUNDS:
        for s in STATES:
            reg.add(StateRoundSpec(s, r, (Branch(f"{r}_{s}", (f"{s}-{r}%",), spelling=SPELLING),)))
    return reg


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical responses of all rounds, tagged with ROUND."""
    reg = plain_registry()
    return build_rounds(raw_calls(spark, sf_dir), reg.select(reg.keys()), reg.books)


# ---- the presets' own states ---------------------------------------------------------------

# Survey state, its code in campaign names and its name, for each region of the tables.
PRESET_STATES = {"R0": ("ap", "AP", "Andhra Pradesh"), "R1": ("od", "OD", "Odisha"), "R2": ("up", "UP", "UTTAR PRADESH"),
                 "R3": ("pb", "PB", "Punjab"), "R4": ("dl", "DL", "Delhi")}
# Orderings read out in each, in the place of the five orderings above.
PRESET_ORDERINGS = {
    "ap": ("TYIO", "YTIO", "BIO", "IBO", "TYO"),
    "od": ("BDIO", "DBIO", "BDO", "DBO", "IBO"),
    "up": ("BSO", "SBO", "BSMO", "SBMO", "XBO"),  # the last has a letter that the state does not know
    "pb": ("ABIO", "BAIO", "AIO", "IAO", "DBAO"),
    "dl": ("ABO", "BAO", "ABIO", "BIAO", "IBO"),
}


def preset_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls with real state codes, names and orderings, dated into the survey's weeks."""
    def by_region(values) -> str:
        arms = " ".join(f"WHEN '{r}' THEN {v}" for r, v in values)
        return f"CASE left(Campaign_Name, 2) {arms} END"

    def ordering(state: str) -> str:
        arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(ORDERINGS, PRESET_ORDERINGS[state]))
        return f"CASE N_PARTY {arms} END"

    code = by_region((r, f"'{c}'") for r, (_, c, _) in PRESET_STATES.items())
    name = by_region((r, f"'{n}'") for r, (_, _, n) in PRESET_STATES.items())
    seq = by_region((r, ordering(s)) for r, (s, _, _) in PRESET_STATES.items())
    return raw_calls(spark, sf_dir).withColumns({
        "state": F.expr(name), "N_PARTY": F.expr(seq),
        "Start_Time": F.expr("CAST(date_add(DATE'2024-04-10', CAST(CALL_ID % 60 AS INT)) AS TIMESTAMP_NTZ)"),
        "DTMF_REP": F.expr("CASE WHEN CALL_ID % 2 = 0 THEN translate(DTMF_REP, '12345', '34567')"
                           " ELSE translate(DTMF_REP, '12345', '56789') END"),
        "Campaign_Name": F.expr(f"concat({code}, substring(Campaign_Name, 3))"),
    })


# ---- branches, windows and schedules derived from the suppliers -----------------------------

SUPPLIER_BRANCH = [
    "concat('S', s_suppkey) AS branch_id",
    "array(concat('R', n_regionkey, '-', CASE s_suppkey % 3 WHEN 0 THEN 'BC' WHEN 1 THEN 'EP' ELSE 'PP' END, '-PC', n_nationkey, '-%'),"
    " CASE WHEN s_suppkey % 4 = 0 THEN concat('R', n_regionkey, '-%-PM') WHEN s_suppkey % 4 = 1 THEN '%-PC7-LSE' END) AS campaign_like",
    "CASE WHEN s_suppkey % 5 = 0 THEN array('%-PC1%') END AS campaign_not_like",
    "CASE WHEN s_suppkey % 7 = 0 THEN 'a%' END AS state_prefix",
    "CASE WHEN s_suppkey % 6 = 0 THEN 'LSE_2019' END AS q2_type",
    "CASE WHEN s_suppkey % 8 = 0 THEN TIMESTAMP_NTZ'1995-01-01' END AS start",
    "CASE WHEN s_suppkey % 9 = 0 THEN TIMESTAMP_NTZ'1997-06-01' END AS end",
    "CASE WHEN s_suppkey % 10 = 0 THEN array(n_nationkey, 3) END AS pc_in",
    "CASE WHEN s_suppkey % 11 = 0 THEN array(n_nationkey) END AS pc_not_in",
]


def supplier_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One branch per supplier, over the campaigns of its nation."""
    return _supplier_nation(spark, sf_dir).selectExpr(*SUPPLIER_BRANCH)


def question_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One window per supplier: from a few days to years long, every tenth without an end."""
    opens = "CAST(date_add(DATE'1992-01-01', CAST(s_suppkey * 37 % 2300 AS INT)) AS TIMESTAMP_NTZ)"
    closes = "CAST(date_add(DATE'1992-01-01', CAST(s_suppkey * 37 % 2300 + pow(3, s_suppkey % 7) AS INT)) AS TIMESTAMP_NTZ)"
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS window_id", "s_nationkey AS PC_NO", f"{opens} AS opens", f"CASE WHEN s_suppkey % 10 <> 0 THEN {closes} END AS closes")


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schedule per supplier: the constituencies of a nation change it on several days, some of them shared."""
    since = "CAST(date_add(DATE'1992-01-01', CAST(s_suppkey * 53 % 120 * 20 AS INT)) AS TIMESTAMP_NTZ)"
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey AS pc", f"{since} AS valid_from", "s_suppkey AS schedule_id", "s_acctbal AS budget")


CALL_LEVELS = {"ac": ("state", "PC_NO", "AC_NO"), "pc": ("state", "PC_NO"), "state": ("state",), "all": ()}


def priced_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls with a duration of many distinct values: the order's price in tenths of a second."""
    raw = raw_calls(spark, sf_dir).select("CALL_ID", "state", "PC_NO", "AC_NO")
    price = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS CALL_ID", "CASE WHEN o_orderkey % 31 <> 0 THEN o_totalprice / 10 END AS duration")
    return raw.join(price, "CALL_ID")
