"""Declared schemas, column groups and scope definitions.

Nothing here touches a session: schemas are plain ``StructType`` objects and scopes are
small frozen records, so importing the package never starts Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "timestamp": T.TimestampType(),
        "date": T.DateType(),
    }
    fields = [line.split() for line in spec.strip().splitlines()]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


RAW_SCHEMA = _struct("""
    DN string
    Campaign_Name string
    VENDOR_ID int
    VENDOR string
    CALL_STATUS string
    Start_Time timestamp
    Call_Duration_Sec_ int
    DTMF_REP string
    PARTY string
    N_PARTY string
    AC_NO int
    PC_NO int
    PART_NO string
    EPIC_NO string
    POLLING_STATION_ADDRESS string
    GENDER string
    AGE int
    CASTE string
    state string
    Q2_Type string
""")

GEO_SCHEMA = _struct("""
    State_Code string
    AC_NO int
""")

GEO_REMAP_SCHEMA = _struct("""
    State_Code string
    AC_NO int
    PC_No int
""")

REGION_SCHEMA = _struct("""
    State_Code string
    AC_NO int
    PC_ID string
    PC_REGION string
""")

# Names and order of a canonical response row.
CANONICAL_COLUMNS = [
    "DN", "Start_Time", "DTMF_REP", "state", "AC_ID", "AC_NO", "PC_ID", "PC_NO",
    "PART_NO", "GENDER", "AGE", "N_PARTY", "RES1", "RES2", "CASTE",
]

# Names of the keys of a score row.
ROW_KEYS = ["AC_ID", "PC_ID", "N_PARTY", "RES1"]
SCORE_KEYS = ["AC_ID", "PC_ID", "AC_NO", "PC_NO", "state", "N_PARTY", "RES1"]

# Columns that never leave the response stage: what a canonical row has beyond a score row.
WORKING_COLUMNS = [c for c in CANONICAL_COLUMNS if c not in SCORE_KEYS]


@dataclass(frozen=True)
class Scope:
    """One grouping in which a winner is computed, and its nine output columns."""

    name: str
    keys: tuple[str, ...]
    count: str
    pct: str
    suffix: str

    @property
    def max_pct(self) -> str:
        return f"MAX_PER_{self.suffix}"

    @property
    def winner(self) -> str:
        return f"WINNER_{self.suffix}"

    @property
    def second(self) -> str:
        return f"2ND_PER_{self.suffix}"

    @property
    def runner_up(self) -> str:
        return f"RUNNER_UP_{self.suffix}"

    @property
    def margin(self) -> str:
        return f"MARGIN_{self.suffix}"

    @property
    def band(self) -> str:
        return f"MARGIN_GROUP_{self.suffix}"

    @property
    def summary(self) -> str:
        return f"SUMMERY_{self.suffix}"

    @property
    def columns(self) -> list[str]:
        return [
            self.count, self.pct, self.max_pct, self.winner, self.second,
            self.runner_up, self.margin, self.band, self.summary,
        ]


# Names of the scopes' output columns.
SCOPES = {
    "ac": Scope("ac", ("AC_ID",), "RES_ACWISE", "AC_WISE_PERCENTAGE", "ACWISE"),
    "pc": Scope("pc", ("PC_ID",), "RES_PCWISE", "PC_WISE_PERCENTAGE", "PCWISE"),
    "seq_ac": Scope("seq_ac", ("AC_ID", "N_PARTY"), "RES_SEQWISE_AC", "SEQ_WISE_PERCENTAGE_AC", "SEQWISE_AC"),
    "seq_pc": Scope("seq_pc", ("PC_ID", "N_PARTY"), "RES_SEQWISE_PC", "SEQ_WISE_PERCENTAGE_PC", "SEQWISE_PC"),
}


def layout(scopes: list[str], tail: tuple[str, ...] = ("REGION", "ROUND")) -> list[str]:
    """Strict column layout: row keys, nine metrics per scope, then ``tail``."""
    metrics = [c for s in scopes for c in SCOPES[s].columns]
    return SCORE_KEYS + metrics + list(tail)


WIDE_LAYOUT = layout(["ac", "pc", "seq_ac", "seq_pc"])  # 45 columns
STORED_LAYOUT = layout(["ac", "pc"])  # 27 columns


class SchemaError(ValueError):
    """A frame does not carry the columns an operator needs."""


def require(df: DataFrame, columns, what: str = "input") -> DataFrame:
    """Fail early, on the driver, when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df
