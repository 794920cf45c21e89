"""Row filters and projections on raw calls, canonical responses and score rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyscore import schema as S
from surveyscore.functions import scalars as fn


def valid_answer(df: DataFrame, answer: str = "DTMF_REP") -> DataFrame:
    """Keep calls with at least one key press."""
    return df.filter(fn.valid_answer_sql(answer))


def like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).like(pattern))


def like_any(df: DataFrame, col: str, patterns) -> DataFrame:
    return df.filter(fn.like_any_sql(col, patterns))


def not_like(df: DataFrame, col: str, patterns) -> DataFrame:
    return df.filter("NOT " + fn.like_any_sql(col, patterns))


def state_prefix(df: DataFrame, pattern: str, col: str = "state") -> DataFrame:
    return df.filter(fn.state_like_sql(col, pattern))


def question_type(df: DataFrame, value: str, col: str = "Q2_Type") -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def in_time(df: DataFrame, start: str | None = None, end: str | None = None,
            end_inclusive: bool = False, col: str = "Start_Time") -> DataFrame:
    return df.filter(fn.time_window_sql(col, start, end, end_inclusive, df.schema[col].dataType))


def pc_in(df: DataFrame, numbers, col: str = "PC_NO") -> DataFrame:
    """Keep the listed constituencies. Numbers may come quoted, as text."""
    return df.filter(F.col(col).isin(*[int(n) for n in numbers]))


def pc_not_in(df: DataFrame, numbers, col: str = "PC_NO") -> DataFrame:
    """Drop the listed constituencies; a NULL number is dropped too, as in SQL."""
    return df.filter(~F.col(col).isin(*[int(n) for n in numbers]))


def pc_known(df: DataFrame, col: str = "PC_NO") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def drop_undecoded(df: DataFrame, label: str = "RES1") -> DataFrame:
    return df.filter(F.col(label).isNotNull() & (F.col(label) != F.lit("")))


def derive_ids(df: DataFrame, code: Column | None = None) -> DataFrame:
    """State code from the campaign name, then the two constituency ids."""
    code = F.substring("Campaign_Name", 1, 2) if code is None else code
    return (
        df.withColumn("STATE_CODE", code)
        .withColumn("AC_ID", fn.ac_id("STATE_CODE", "AC_NO"))
        .withColumn("PC_ID", fn.pc_id("STATE_CODE", "PC_NO"))
    )


# Names used by single sources, and the canonical name of each.
SOURCE_NAMES = {
    "MOBILE": "DN",
    "STIME": "Start_Time",
    "RESPONSE": "DTMF_REP",
    "BOOTH": "PART_NO",
    "SEQ": "N_PARTY",
}


def with_defaults(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns: a text, a number, or a typed NULL given as ``("int", None)``."""
    cols = {}
    for name, value in constants.items():
        kind, value = value if isinstance(value, tuple) else (None, value)
        cols[name] = F.lit(value).cast(kind) if kind else F.lit(value)
    return df.withColumns(cols)


def to_canonical(df: DataFrame, date_only: bool = False) -> DataFrame:
    """Rename to the canonical names and project the fifteen columns in order."""
    present = set(df.columns)
    names = {new: old for old, new in SOURCE_NAMES.items() if old in present}
    out = df.select("*") if not names else df.select(
        *[c for c in df.columns if c not in names and c not in names.values()],
        *[F.col(old).alias(new) for new, old in names.items()],
    )
    if "RES2" not in out.columns:
        out = out.withColumn("RES2", F.lit(""))
    S.require(out, S.CANONICAL_COLUMNS, "canonical response")
    if date_only:
        out = out.withColumn("Start_Time", F.col("Start_Time").cast("date"))
    return out.select(*S.CANONICAL_COLUMNS)


def with_round(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("ROUND", F.lit(name))


def drop_working_cols(df: DataFrame, columns=tuple(S.WORKING_COLUMNS)) -> DataFrame:
    """Drop respondent details and totals; names that are absent are ignored."""
    return df.drop(*columns)


def reorder(df: DataFrame, tail) -> DataFrame:
    """Move the ``tail`` columns that exist to the end, in that order; the rest keep their place."""
    ordered = [c for c in tail if c in df.columns]
    front = [c for c in df.columns if c not in ordered]
    return df.select(*front, *ordered)


def project_layout(df: DataFrame, columns) -> DataFrame:
    S.require(df, columns, "layout")
    return df.select(*columns)
