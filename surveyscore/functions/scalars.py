"""Expressions shared by the operators, as Spark SQL text and as columns.

Plans of many branches hold thousands of small expressions. Writing them as SQL text crosses from
Python to the JVM once per expression instead of once per node. Arguments are column names or SQL
text. There are no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Answers that carry no key press.
EMPTY_ANSWERS = ("", ",,")

# Upper bound of each margin band in percent, and its label.
MARGIN_BANDS = ((5, "0-5%"), (10, "6-10%"), (20, "11-20%"), (30, "21-30%"))
MARGIN_ABOVE = "Above 30%"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """A column name."""
    return "`" + name.replace("`", "``") + "`"


def numbers(values) -> str:
    return ", ".join(str(int(v)) for v in values)


# ---- SQL text ----------------------------------------------------------------------------


def hundredths_sql(part: str, total: str) -> str:
    """Percentage in whole hundredths, rounded half up; NULL for an empty total.

    Integer arithmetic keeps the result exact, so equal shares compare equal and the value
    does not depend on how an engine rounds doubles.
    """
    return f"CASE WHEN {total} > 0 THEN (({part}) * 20000 + {total}) div ({total} * 2) END"


def as_pct_sql(hundredths: str) -> str:
    return f"CAST({hundredths} AS DOUBLE) / 100.0D"


def margin_bucket_sql(margin: str) -> str:
    """Band of a margin in percent. NULL and negative margins fall in the last band."""
    arms, low = "", None
    for top, label in MARGIN_BANDS:
        above = f"{margin} >= 0" if low is None else f"{margin} > {low}"
        arms += f" WHEN {above} AND {margin} <= {top} THEN {text(label)}"
        low = top
    return f"CASE{arms} ELSE {text(MARGIN_ABOVE)} END"


def summary_sql(winner: str, margin: str, runner_up: str) -> str:
    """``W m (R)``; ``DRAW`` for a draw; NULL when a part is NULL."""
    return (f"CASE WHEN {winner} = 'DRAW' THEN 'DRAW' "
            f"ELSE concat({winner}, ' ', CAST({margin} AS STRING), ' (', {runner_up}, ')') END")


def valid_answer_sql(answer: str = "DTMF_REP") -> str:
    empty = ", ".join(text(a) for a in EMPTY_ANSWERS)
    return f"{answer} IS NOT NULL AND {answer} NOT IN ({empty})"


def first_key_sql(answer: str) -> str:
    return f"substring_index({answer}, ',', 1)"


def more_keys_sql(answer: str) -> str:
    return f"contains({answer}, ',')"


def like_any_sql(col: str, patterns) -> str:
    """Disjunction of LIKE patterns. Catalyst turns plain prefixes into pushed StartsWith."""
    return "(" + " OR ".join(f"{col} LIKE {text(p)}" for p in patterns) + ")"


def state_like_sql(col: str, pattern: str) -> str:
    """State names occur in several cases, so the match ignores case; ``_`` is one character."""
    return f"upper({col}) LIKE {text(pattern.upper())}"


def time_window_sql(col: str, start: str | None = None, end: str | None = None,
                    end_inclusive: bool = False, dtype: T.DataType | None = None) -> str:
    """Time range. Only the literal is cast, to the column's own type, so it can be pushed down."""
    kind = (dtype or T.TimestampType()).simpleString()
    parts = []
    if start is not None:
        parts.append(f"{col} >= CAST({text(start)} AS {kind})")
    if end is not None:
        parts.append(f"{col} {'<=' if end_inclusive else '<'} CAST({text(end)} AS {kind})")
    if not parts:
        raise ValueError("a time window needs a start or an end")
    return " AND ".join(parts)


def ac_id_sql(code: str, ac_no: str) -> str:
    return f"concat({code}, '-AC-', CAST({ac_no} AS STRING))"


def pc_id_sql(code: str, pc_no: str) -> str:
    return f"concat({code}, '-', CAST({pc_no} AS STRING))"


# ---- columns -----------------------------------------------------------------------------


def hundredths(part: str, total: str) -> Column:
    return F.expr(hundredths_sql(part, total))


def pct(part: str, total: str) -> Column:
    """``part`` of ``total`` in percent with two decimals."""
    return F.expr(as_pct_sql(hundredths_sql(part, total)))


def margin_bucket(margin: str) -> Column:
    return F.expr(margin_bucket_sql(margin))


def summary_text(winner: str, margin: str, runner_up: str) -> Column:
    return F.expr(summary_sql(winner, margin, runner_up))


def first_key(answer: str) -> Column:
    return F.expr(first_key_sql(answer))


def ac_id(code: str, ac_no: str) -> Column:
    return F.expr(ac_id_sql(code, ac_no))


def pc_id(code: str, pc_no: str) -> Column:
    return F.expr(pc_id_sql(code, pc_no))
