"""Joins and groups along time: intervals, the value in force, and sessions.

All three cut time into parts, so that a key with a large part of the table is spread over as many
tasks as it has parts; what crosses a border between parts is settled on a few rows per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore.rules import broadcast_if_small
from surveyscore.sources.sinks import materialise

DAY = 86_400
SPLIT = 1_000_000  # points of one key and bin that go to one task


def micros(df: DataFrame, column: str) -> str:
    """SQL for a column's time in microseconds: of an instant, or of a date or local time as it stands."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({column})"
    if isinstance(kind, T.DateType):
        return f"unix_date({column}) * {DAY}000000L"
    return (f"(unix_date(CAST({column} AS DATE)) * {DAY}000000L + hour({column}) * 3600000000L"
            f" + minute({column}) * 60000000L + CAST(extract(SECOND FROM {column}) * 1000000 AS BIGINT))")


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, keys=(),
                  split: int = SPLIT) -> DataFrame:
    """Every point with each interval of its key that holds it: start <= at < end.

    Returns the columns of both sides, keys once. A NULL end is open; a NULL start, key or time
    meets nothing, and neither does an interval that ends where it starts, or before. Pairs come out
    as often as both rows occur.

    Bins have widths of powers of two. An interval lies in one or two bins of the least width that
    is not below its length; a point looks into one bin of each width that occurs. So every pair
    meets in exactly one bin, long and open intervals do not multiply, and the join is an
    equi-join. Bins that hold more than ``split`` points are dealt over several tasks, and only
    their intervals are repeated.
    """
    clash = (set(points.columns) & set(intervals.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a, b = micros(intervals, start), micros(intervals, end)
    spans = intervals.selectExpr("*", f"{a} AS __a", f"{b} AS __b").where("__a IS NOT NULL AND (__b IS NULL OR __a < __b)")
    # 62 is the width of all time: one bin, for open intervals.
    spans = spans.selectExpr("*", "CASE WHEN __b IS NULL THEN 62 ELSE CAST(ceil(log2(greatest(__b - __a, 1) + 0.5)) AS INT) END AS __w")
    bins = "CASE WHEN __w = 62 THEN array(0L) ELSE array_distinct(array(shiftright(__a, __w), shiftright(__b - 1, __w))) END"
    spans = spans.selectExpr("*", f"explode({bins}) AS __bin")
    widths = sorted(r[0] for r in spans.select("__w").distinct().collect())  # at most 63
    looks = points.selectExpr("*", f"{micros(points, at)} AS __t").where("__t IS NOT NULL")
    looks = looks.withColumn("__w", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")))
    looks = looks.selectExpr("*", "CASE WHEN __w = 62 THEN 0L ELSE shiftright(__t, __w) END AS __bin")
    cell = [*keys, "__w", "__bin"]
    hot = looks.groupBy(*cell).agg(F.count("*").alias("__n")).where(F.col("__n") > split)
    hot = broadcast_if_small(materialise(hot.select(*cell, F.ceil(F.col("__n") / split).cast("int").alias("__parts")), "hot-bins"))
    # By the row itself, so that a task that runs again deals as it did before.
    dealt = F.pmod(F.xxhash64(*[f.name for f in points.schema if not isinstance(f.dataType, T.MapType)]), F.col("__parts")).cast("int")
    spans = spans.join(hot, cell, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
    looks = looks.join(hot, cell, "left").withColumn("__part", F.coalesce(dealt, F.lit(0)))
    pairs = looks.drop("__parts").join(spans.drop("__parts"), [*cell, "__part"]).where("__t >= __a AND (__b IS NULL OR __t < __b)")
    others = [c for c in intervals.columns if c not in keys]
    return pairs.select(*points.columns, *others)


def asof_join(rows: DataFrame, values: DataFrame, at: str, since: str, keys, part_days: int = 30, tie: str | None = None) -> DataFrame:
    """Each row with the value of its key that is in force at its time: the latest ``since`` <= ``at``.

    Returns every row of ``rows`` once, with the other columns of ``values`` (NULL where nothing is
    in force, or the row's time or a key is NULL). Of values with one key and time the greatest
    counts, by ``tie`` and then by all columns.

    Both sides are merged in parts of ``part_days``: within a part a running last value, and at its
    beginning the value carried over from the parts before. Carried values come from the small side
    and one row per key and part, so a key that holds a third of the rows is as many tasks as parts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    own = [c for c in values.columns if c not in keys and c != since]
    fit = " AND ".join(f"{c} IS NOT NULL" for c in ["__t", *keys])

    def parted(df: DataFrame) -> DataFrame:
        return df.selectExpr("*", f"CAST(floor({micros(df, '__t')} / {part_days * DAY * 1_000_000}) AS BIGINT) AS __part")

    order = [tie, *[c for c in own if c != tie]] if tie else own
    known = values.where(" AND ".join(f"{c} IS NOT NULL" for c in [since, *keys]))
    value = "struct(" + ", ".join(f"{c} AS v{k}" for k, c in enumerate([since, *order])) + ")"
    known = known.selectExpr(*keys, f"{since} AS __t", f"{value} AS __v")
    known = parted(known)
    whole = parted(rows.selectExpr("struct(*) AS __row", *keys, f"{at} AS __t"))
    # Rows that nothing can be in force for are dealt over parts of their own.
    spread = F.pmod(F.xxhash64(*[F.col(f"__row.{f.name}") for f in rows.schema if not isinstance(f.dataType, T.MapType)]), F.lit(997))
    whole = whole.withColumn("__part", F.when(F.expr(fit), F.col("__part")).otherwise(spread))
    # The last value of each part, then of the parts before it: one row per key and part.
    last = known.groupBy(*keys, "__part").agg(F.max("__v").alias("__v"))
    places = last.unionByName(whole.where(fit).select(*keys, "__part").distinct(), allowMissingColumns=True)
    places = places.groupBy(*keys, "__part").agg(F.max("__v").alias("__v"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select(*keys, "__part", F.last("__v", ignorenulls=True).over(before).alias("__v")).where("__v IS NOT NULL")
    merged = whole.withColumn("__side", F.lit(2)).unionByName(
        known.withColumn("__side", F.lit(1)), allowMissingColumns=True).unionByName(
        carried.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    running = Window.partitionBy(*keys, "__part").orderBy("__t", "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    # A carried value has no time, so it sorts first; rows without a time do as well and take nothing.
    found = merged.withColumn("__found", F.last("__v", ignorenulls=True).over(running)).where("__side = 2")
    named = [F.expr(f"CASE WHEN {fit} THEN __found.v{k} END").alias(c) for k, c in enumerate([since, *order])]
    return found.select("__row.*", *named).select(*rows.columns, since, *own)


def sessions(events: DataFrame, key: str, at: str, gap_minutes: int = 30, answered: str | None = None,
             part_days: int = 7) -> DataFrame:
    """Sessions of each key: runs of events with no gap above ``gap_minutes``.

    Returns key, session_start, session_end, n_events, first_answer and seconds_to_answer (from the
    session's start to its first event for which the condition ``answered`` holds; NULL without
    one). Events without a time are left out; a NULL key is a key of its own. Events at one time
    belong together; repeated rows count as often as they occur.

    Gaps and islands in two passes. Within parts of ``part_days`` each key is cut at its gaps. Only
    the first and last island of a part can go on in another, so only those meet in a window over
    the whole key; all others are sessions already.
    """
    gap = gap_minutes * 60 * 1_000_000
    cut = events.where(f"{at} IS NOT NULL").selectExpr(
        f"{key} AS __k", f"{at} AS __at", f"{micros(events, at)} AS __t", f"CASE WHEN {answered or 'false'} THEN {at} END AS __answer")
    cut = cut.selectExpr("*", f"CAST(floor(__t / {part_days * DAY * 1_000_000}) AS BIGINT) AS __part")
    own = Window.partitionBy("__k", "__part").orderBy("__t")
    cut = cut.withColumn("__new", (F.col("__t") - F.lag("__t").over(own) > gap).cast("int"))
    cut = cut.withColumn("__no", F.sum(F.coalesce("__new", F.lit(0))).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    island = cut.groupBy("__k", "__part", "__no").agg(
        F.min("__at").alias("session_start"), F.max("__at").alias("session_end"), F.min("__t").alias("__a"), F.max("__t").alias("__b"),
        F.count("*").alias("n_events"), F.min("__answer").alias("first_answer"))
    # The grouping above keeps the partitioning of the windows, so this is no new exchange.
    island = island.withColumn("__last", F.max("__no").over(Window.partitionBy("__k", "__part")))
    inner = island.where("__no > 0 AND __no < __last")
    border = island.where("__no = 0 OR __no = __last")
    order = Window.partitionBy("__k").orderBy("__a")
    border = border.withColumn("__new", (F.col("__a") - F.lag("__b").over(order) > gap).cast("int"))
    border = border.withColumn("__s", F.sum(F.coalesce("__new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    closed = border.groupBy("__k", "__s").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("n_events").alias("n_events"), F.min("first_answer").alias("first_answer"))
    columns = ["__k", "session_start", "session_end", "n_events", "first_answer"]
    both = inner.select(*columns).unionByName(closed.select(*columns))
    took = f"({micros(both, 'first_answer')} - {micros(both, 'session_start')}) / 1000000.0"
    return both.selectExpr(f"__k AS {key}", *columns[1:], f"CAST({took} AS DOUBLE) AS seconds_to_answer")
