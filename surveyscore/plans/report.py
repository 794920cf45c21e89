"""Report on score rows: filter, sort, page, drop-down values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAGE_SIZE = 30  # fixed value: rows of a report page
SORT_KEYS = ("state", "AC_NO", "RES1", "ROUND")


def slice_rows(df: DataFrame, state: str | None = None, ac_no: int | str | None = None,
               res1: str | None = None, round: str | None = None) -> DataFrame:
    """Optional equality filters, applied in turn; an empty value means no filter."""
    wanted = {"state": state, "AC_NO": ac_no, "RES1": res1, "ROUND": round}
    for name, value in wanted.items():
        if value not in (None, ""):
            df = df.filter(F.col(name) == (int(value) if name == "AC_NO" else value))
    return df


def _order(df: DataFrame):
    """Report order, extended by the row keys to a total one so pages never overlap."""
    keys = [k for k in (*SORT_KEYS, "PC_ID", "AC_ID", "N_PARTY") if k in df.columns]
    return [F.col(k).asc_nulls_last() for k in keys]


def sort_rows(df: DataFrame) -> DataFrame:
    return df.orderBy(*_order(df))


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def distinct_values(df: DataFrame, col: str, numeric: bool = False) -> DataFrame:
    """Sorted distinct values of a column, for a drop-down; NULL is not an option."""
    value = F.col(col).cast("int") if numeric else F.col(col)
    return df.select(value.alias(col)).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def page_count(total: int, size: int = PAGE_SIZE) -> int:
    return max(1, -(-total // size))


def clamp_page(page, pages: int) -> int:
    """Page number to show: text or nothing gives the first, a number out of range the last."""
    try:
        n = int(page)
    except (TypeError, ValueError):
        return 1
    return n if 1 <= n <= pages else pages


def page_rows(df: DataFrame, page=1, size: int = PAGE_SIZE, total: int | None = None) -> DataFrame:
    """One page in report order. Only the scalar row count reaches the driver.

    Rows are counted per constituency first, so only the one or few constituencies the page falls
    into are ranked. A late page costs no more than the first; nothing sorts the whole table in
    one task: the first window goes over states, the second over the constituencies of each.
    """
    total = df.count() if total is None else total
    start = (clamp_page(page, page_count(total, size)) - 1) * size
    place = ["state", "AC_NO"]
    states = Window.orderBy(F.col("state").asc_nulls_last())  # one row per state
    inside = Window.partitionBy("state").orderBy(F.col("AC_NO").asc_nulls_last())
    groups = df.groupBy(*place).agg(F.count(F.lit(1)).alias("__n"))
    starts = groups.groupBy("state").agg(F.sum("__n").alias("__s")).select(
        F.col("state").alias("__state"), (F.sum("__s").over(states) - F.col("__s")).alias("__before"))
    groups = groups.withColumn("__at", F.sum("__n").over(inside) - F.col("__n")).join(
        starts, F.col("state").eqNullSafe(F.col("__state")))
    groups = groups.select("__state", F.col("AC_NO").alias("__AC_NO"), "__n", (F.col("__before") + F.col("__at")).alias("__first"))
    on_page = groups.filter((F.col("__first") < start + size) & (F.col("__first") + F.col("__n") > start))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place]
    within = Window.partitionBy(*[f"__{c}" for c in place]).orderBy(*_order(df))
    at = F.col("__first") + F.row_number().over(within)
    rows = df.join(on_page, same).withColumn("__at", at)
    rows = rows.filter((F.col("__at") > start) & (F.col("__at") <= start + size))
    return sort_rows(rows.select(*df.columns))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


@dataclass
class Report:
    rows: DataFrame
    total: int
    pages: int
    states: DataFrame
    ac_numbers: DataFrame
    parties: DataFrame


def report(df: DataFrame, page=1, size: int = PAGE_SIZE, **filters) -> Report:
    """A filtered, sorted page with its totals and the values to offer as further filters.

    ``df`` should be a stored score table: the page, the total and the three lists each read it.
    """
    chosen = slice_rows(df, **filters)
    total = chosen.count()
    return Report(
        rows=page_rows(chosen, page, size, total),
        total=total,
        pages=page_count(total, size),
        states=distinct_values(df, "state"),
        ac_numbers=distinct_values(chosen if filters.get("state") else chosen.limit(0), "AC_NO", numeric=True),
        parties=distinct_values(chosen, "RES1"),
    )
