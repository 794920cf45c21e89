"""One response per respondent, and one score row per key.

Three rules that must not be mixed up:

* latest call per number, decided before any decode filter;
* the same again over united branches;
* column-wise maximum per number, which may combine values of several calls.

All three cut each number down on the map side first, so a number that holds a large part of
the table sends at most one row per map task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyscore import schema as S


def latest_per_key(df: DataFrame, keys="DN", order: str = "Start_Time", tie=None) -> DataFrame:
    """Keep the row with the greatest ``order`` per key; ties fall to ``tie``, greatest first.

    ``tie`` defaults to every other column, which makes the choice independent of row order.
    The rank-then-filter shape lets Catalyst place a partial ``WindowGroupLimit`` before the
    exchange.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tie is None:
        tie = sorted(c for c in df.columns if c not in keys and c != order)
    ordering = [F.col(c).desc_nulls_last() for c in [order, *tie]]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def collapse_max(df: DataFrame, keys="DN", columns=None) -> DataFrame:
    """Maximise every column on its own per key (text by its order as text)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = columns or [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def distinct_scores(df: DataFrame, keys=tuple(S.ROW_KEYS)) -> DataFrame:
    """One whole row per key: the least by its other columns in their order, NULL first.

    Equal rows are cut first: that step is hash-based and combines on the map side, whatever the
    column types.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    least = df.distinct().groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return least.select(*keys, "__row.*").select(*df.columns)
