"""Unions and joins that put branches, rounds and scopes together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore import schema as S


def union_all(dfs) -> DataFrame:
    """UNION ALL by name; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def pool_rounds(*rounds: DataFrame) -> DataFrame:
    """Pool canonical responses of several rounds; a number counts once per round."""
    return union_all([r.select(*S.CANONICAL_COLUMNS) for r in rounds])


def stack_rounds(dfs) -> DataFrame:
    """Long form: scored rounds under each other; a column one round lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _null_safe_left(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys],
                           *[c for c in right.columns if c not in left.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(renamed, cond, "left").drop(*[f"__{k}" for k in keys])


def combine_scopes(dfs, keys=None) -> DataFrame:
    """Put separately scored scopes side by side on the full row key, from the first frame.

    Keys compare NULL-safe, so a row without a region or constituency keeps its other scopes.
    """
    first = dfs[0]
    keys = keys or [c for c in (*S.SCORE_KEYS, "REGION") if c in first.columns]
    return reduce(lambda a, b: _null_safe_left(a, b, keys), dfs)


def join_stored(left: DataFrame, right: DataFrame, keys=tuple(S.ROW_KEYS)) -> DataFrame:
    """Left join of two stored scope tables; common columns come from the left one.

    Keys compare by plain equality, as a database join does.
    """
    extra = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*keys, *extra), list(keys), "left").select(*left.columns, *extra)


def combine_rounds_wide(long: DataFrame, rounds, base: str | None = None, keys=tuple(S.ROW_KEYS),
                        metrics=None) -> DataFrame:
    """Wide form: one row per row key, metrics of each round under a ``ROUND_`` prefix.

    ``base`` keeps only rows present in that round (a left join from it); by default no row is
    lost. A round that is not listed is an error. One conditional aggregation replaces a chain of
    joins; constituency attributes come from one whole row.
    """
    attrs = [c for c in (*S.SCORE_KEYS, "REGION") if c in long.columns and c not in keys]
    metrics = metrics or [c for c in long.columns if c not in (*keys, *attrs, "ROUND")]
    aggs = [F.min(F.struct(*attrs)).alias("__attrs")] if attrs else []
    for r in rounds:
        aggs += [F.max(F.when(F.col("ROUND") == r, F.col(m))).alias(f"{r}_{m}") for m in metrics]
    if base is not None:
        aggs.append(F.max(F.col("ROUND") == base).alias("__base"))
    stray = F.raise_error(F.concat(F.lit("round not listed: "), F.coalesce("ROUND", F.lit("NULL"))))
    listed = F.when(F.coalesce(F.col("ROUND").isin(*rounds), F.lit(False)), F.col("ROUND")).otherwise(stray)
    out = long.withColumn("ROUND", listed).groupBy(*keys).agg(*aggs)
    if base is not None:
        out = out.filter("__base").drop("__base")
    return out.select(*keys, *(["__attrs.*"] if attrs else []), *[c for c in out.columns if c not in (*keys, "__attrs")])
