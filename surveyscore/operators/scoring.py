"""Counts, percentages, winner, runner-up, margin, band and summary per scope.

Raw responses are read once: they are counted per (AC, PC, ordering, label), with map-side
combine, and everything after works on that small table. A constituency that holds a third of
all responses is still a handful of rows by then. The two exchanges that follow (by PC, by AC)
serve all windows of all scopes, because every window key starts with one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyscore import schema as S
from surveyscore.functions import scalars as fn
from surveyscore.schema import SCOPES, Scope

_CARRIED_NUMBERS = ("AC_NO", "PC_NO")
_CARRIED_TEXTS = ("state", "REGION")


def _scope(scope: Scope | str) -> Scope:
    return SCOPES[scope] if isinstance(scope, str) else scope


def scope_counts(resp: DataFrame, scope: Scope | str, by=()) -> DataFrame:
    """Responses per scope and label (calls with a number)."""
    s = _scope(scope)
    return resp.groupBy(*by, *s.keys, "RES1").agg(F.count("DN").alias(s.count))


def counts_by_date(resp: DataFrame) -> DataFrame:
    """Responses per AC, day and label."""
    day = F.col("Start_Time").cast("date").alias("Start_Time")
    return resp.groupBy("AC_ID", day, "RES1").agg(F.count("DN").alias("RES_DATEWISE"))


def counts_by_region(resp: DataFrame) -> DataFrame:
    """Responses per AC, region and label."""
    return resp.groupBy("AC_ID", "REGION", "RES1").agg(F.count("DN").alias("RES_REGIONWISE_AC"))


def _with_windows(df: DataFrame, scopes: list[Scope], by=()) -> DataFrame:
    """Add label count, total, best and second-best label per scope to partial counts ``__n``.

    Order of labels: count descending, then label, for winner and runner-up alike. The scopes
    share the partitioning of ``df``, so this adds sorts but no exchange.
    """
    counts, bests, seconds = [], [], []
    for s in scopes:
        c, t, first, second = (f"__{s.name}_{x}" for x in ("c", "t", "1", "2"))
        keys = ", ".join([*by, *s.keys])
        rank = f"struct(-{c} AS c, RES1 AS l)"
        counts.append(f"sum(__n) OVER (PARTITION BY {keys}, RES1) AS {c}")
        bests.append(f"sum(__n) OVER (PARTITION BY {keys}) AS {t}")
        bests.append(f"min({rank}) OVER (PARTITION BY {keys}) AS {first}")
        other = f"CASE WHEN NOT (RES1 <=> {first}.l) THEN {rank} END"
        seconds.append(f"min({other}) OVER (PARTITION BY {keys}) AS {second}")
    return df.selectExpr("*", *counts).selectExpr("*", *bests).selectExpr("*", *seconds)


def _with_dense_seconds(df: DataFrame, s: Scope, by=()) -> DataFrame:
    """Replace a scope's runner-up by every label of the second-highest distinct percentage.

    Shares are known by now, so this is two more windows over the same partitions; labels that
    share the place repeat the row.
    """
    keys = ", ".join([*by, *s.keys])
    known = " AND ".join(f"{k} IS NOT NULL" for k in s.keys)
    h, h1, h2 = (f"__{s.name}_{x}" for x in ("h", "h1", "h2"))
    below = f"max(CASE WHEN {h} < {h1} THEN {h} END) OVER (PARTITION BY {keys}) AS __below"
    labels = f"collect_set(CASE WHEN {h} = __below THEN RES1 END) OVER (PARTITION BY {keys})"
    out = df.drop(s.runner_up, h2).selectExpr("*", below)
    out = out.selectExpr("*", f"CASE WHEN {known} THEN {labels} END AS __labels")
    out = out.selectExpr("*", f"explode_outer(__labels) AS {s.runner_up}")
    return out.selectExpr("*", f"CASE WHEN {s.runner_up} IS NOT NULL THEN __below END AS {h2}").drop("__below", "__labels")


def _with_metrics(df: DataFrame, scopes: list[Scope], on_tie: str = "first", method: str = "row", by=()) -> DataFrame:
    """The nine metrics of every scope, from its windows.

    A NULL scope key keeps counts, percentages and maximum, but names no winner. Shares are held
    in whole hundredths until the end; each stage reads the columns of the one before, so no
    expression is written out twice.
    """
    if on_tie not in ("first", "draw"):
        raise ValueError("on_tie is 'first' or 'draw'")
    if method not in ("row", "dense"):
        raise ValueError("method is 'row' or 'dense'")
    if method == "dense" and len(scopes) > 1:
        raise ValueError("tied runners-up repeat rows: score one scope at a time")
    shares, names, texts = [], [], []
    for s in scopes:
        c, t, first, second, h, h1, h2 = (f"__{s.name}_{x}" for x in ("c", "t", "1", "2", "h", "h1", "h2"))
        known = " AND ".join(f"{k} IS NOT NULL" for k in s.keys)
        won = f"{first}.l"
        if on_tie == "draw":
            won = f"CASE WHEN {first}.c = {second}.c THEN 'DRAW' ELSE {won} END"
        shares += [
            f"{c} AS {s.count}",
            f"{fn.hundredths_sql(c, t)} AS {h}",
            f"{fn.hundredths_sql(f'-{first}.c', t)} AS {h1}",
            f"CASE WHEN {known} THEN {fn.hundredths_sql(f'-{second}.c', t)} END AS {h2}",
            f"CASE WHEN {known} THEN {won} END AS {s.winner}",
            f"CASE WHEN {known} THEN {second}.l END AS {s.runner_up}",
        ]
        names += [
            f"{fn.as_pct_sql(h)} AS {s.pct}",
            f"{fn.as_pct_sql(h1)} AS {s.max_pct}",
            f"{fn.as_pct_sql(h2)} AS {fn.quoted(s.second)}",
            f"{fn.as_pct_sql(f'({h1} - {h2})')} AS {s.margin}",
        ]
        texts += [
            f"{fn.margin_bucket_sql(s.margin)} AS {s.band}",
            f"{fn.summary_sql(s.winner, s.margin, s.runner_up)} AS {s.summary}",
        ]
    df = df.selectExpr("*", *shares)
    if method == "dense":
        df = _with_dense_seconds(df, scopes[0], by)
    return df.selectExpr("*", *names).selectExpr("*", *texts)


def scope_table(resp: DataFrame, scope: Scope | str, by=(), on_tie: str = "first") -> DataFrame:
    """One row per scope key and label with all nine metrics."""
    s = _scope(scope)
    base = resp.groupBy(*by, *s.keys, "RES1").agg(F.count("DN").alias("__n"))
    out = _with_metrics(_with_windows(base.repartition(*by, *s.keys), [s], by), [s], on_tie)
    return out.select(*by, *s.keys, "RES1", *s.columns)


def percentages(resp: DataFrame, scope: Scope | str) -> DataFrame:
    s = _scope(scope)
    return scope_table(resp, s).select(*s.keys, "RES1", s.count, s.pct)


def max_percentage(resp: DataFrame, scope: Scope | str) -> DataFrame:
    s = _scope(scope)
    return scope_table(resp, s).groupBy(*s.keys).agg(F.max(s.max_pct).alias(s.max_pct))


def winner(resp: DataFrame, scope: Scope | str, on_tie: str = "first") -> DataFrame:
    """Winning label per scope key; with ``on_tie="draw"`` a shared first place reads DRAW."""
    s = _scope(scope)
    t = scope_table(resp, s, on_tie=on_tie)
    return t.groupBy(*s.keys).agg(F.min(s.winner).alias(s.winner))


def runner_up(resp: DataFrame, scope: Scope | str, method: str = "row") -> DataFrame:
    """Second label per scope key with its percentage.

    ``row`` gives one label, ordered by percentage, count and label. ``dense`` gives every label
    that holds the second-highest distinct percentage.
    """
    s = _scope(scope)
    t = scope_table(resp, s)
    if method == "row":
        return (
            t.groupBy(*s.keys)
            .agg(F.min(s.runner_up).alias(s.runner_up), F.min(s.second).alias(s.second))
            .filter(F.col(s.runner_up).isNotNull())
        )
    if method != "dense":
        raise ValueError("method is 'row' or 'dense'")
    w = Window.partitionBy(*s.keys).orderBy(F.col(s.pct).desc())
    return (
        t.select(*s.keys, "RES1", s.pct, F.dense_rank().over(w).alias("__r"))
        .filter(F.col("__r") == 2)
        .select(*s.keys, F.col("RES1").alias(s.runner_up), F.col(s.pct).alias(s.second))
    )


def margin(resp: DataFrame, scope: Scope | str) -> DataFrame:
    s = _scope(scope)
    t = scope_table(resp, s)
    return t.select(*s.keys, s.max_pct, s.second, s.margin).distinct()


def preaggregate(resp: DataFrame, by=()) -> DataFrame:
    """Count responses per row key: the only step that sees raw rows.

    Text attributes join the grouping key here, which keeps the aggregation hash-based; they are
    folded to one per row key afterwards, on the small table.
    """
    texts = [c for c in _CARRIED_TEXTS if c in resp.columns]
    numbers = [F.min(c).alias(c) for c in _CARRIED_NUMBERS if c in resp.columns]
    return resp.groupBy(*by, *S.ROW_KEYS, *texts).agg(F.count("DN").alias("__n"), *numbers)


def _fold(base: DataFrame, by=()) -> DataFrame:
    """One row per row key; its attributes come from one whole row."""
    carried = [c for c in (*_CARRIED_NUMBERS, *_CARRIED_TEXTS) if c in base.columns]
    if not carried:
        return base.groupBy(*by, *S.ROW_KEYS).agg(F.sum("__n").alias("__n"))
    out = base.groupBy(*by, *S.ROW_KEYS).agg(F.sum("__n").alias("__n"), F.min(F.struct(*carried)).alias("__row"))
    return out.select(*by, *S.ROW_KEYS, "__n", "__row.*")


def score_base(base: DataFrame, scopes=tuple(SCOPES), by=(), on_tie: str = "first", method: str = "row") -> DataFrame:
    """Score a pre-aggregate. One exchange by PC and one by AC, whichever scopes ask for them.

    A stored pre-aggregate serves any number of scopes, rounds and pools without another look at
    the responses.
    """
    chosen = [_scope(s) for s in scopes]
    folded = False
    for key in ("PC_ID", "AC_ID"):
        group = [s for s in chosen if s.keys[0] == key]
        if not group:
            continue
        base = base.repartition(*by, key)
        if not folded:
            base, folded = _fold(base, by), True
        base = _with_windows(base, group, by)
    base = _with_metrics(base, chosen, on_tie, method, by)
    front = [c for c in S.SCORE_KEYS if c in base.columns]
    tail = [c for c in ("REGION",) if c in base.columns]
    return base.select(*front, *[c for s in chosen for c in s.columns], *tail, *by)


def score_scope(resp: DataFrame, scope: Scope | str, on_tie: str = "first",
                method: str = "row", by=()) -> DataFrame:
    """Score rows of one scope, one per (AC, PC, ordering, label).

    ``method="dense"`` takes the runner-up by dense rank; tied runners-up repeat the row.
    """
    return score_base(preaggregate(resp, by), (_scope(scope),), by, on_tie, method)


def score_all(resp: DataFrame, on_tie: str = "first", by=()) -> DataFrame:
    """Score rows with all four scopes side by side."""
    return score_base(preaggregate(resp, by), tuple(SCOPES), by, on_tie)


def pooled_base(base: DataFrame, pooled: str = "COM") -> DataFrame:
    """A pre-aggregate by ROUND with every row also filed under the round ``pooled``."""
    return base.withColumn("ROUND", F.explode(F.array(F.col("ROUND"), F.lit(pooled))))


def score_rounds(resp: DataFrame, pooled: str | None = "COM", scopes=tuple(SCOPES),
                 on_tie: str = "first", method: str = "row") -> DataFrame:
    """Score every ROUND of ``resp``, and all rounds pooled, from one pass over the responses.

    Pooled counts are sums of the per-round counts (a number counts once per round), so each
    pre-aggregated row is simply also filed under ``pooled``. ``method="dense"`` takes one scope.
    """
    base = preaggregate(resp, ("ROUND",))
    if pooled is not None:
        base = pooled_base(base, pooled)
    return score_base(base, scopes, ("ROUND",), on_tie, method)
