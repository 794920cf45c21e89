"""Exact distinct counts and percentiles at several levels, from one small pre-aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore.operators.combine import union_all
from surveyscore.rules import broadcast_if_small
from surveyscore.sources.sinks import materialise

BINS = 256  # bins that an interval is cut into at a time


def number_respondents(rows: DataFrame, near: Sequence[str], number: str = "DN") -> DataFrame:
    """Stored dictionary of numbers: the number and ``respondent``, dense within each of its parts.

    Numbers are listed by their least combination of ``near``, the keys that will be counted by, so
    that the respondents of a place have neighbouring ids: a bitmap covers a range of 32,768 ids, and
    a place then needs few of them. NULL is no respondent.
    """
    known = rows.where(F.col(number).isNotNull()).groupBy(number).agg(F.min(F.struct(*near)).alias("home"))
    listed = materialise(known.repartitionByRange("home", number).sortWithinPartitions("home", number).select(number), "numbers")
    return materialise(listed.withColumn("respondent", F.monotonically_increasing_id()), "respondents")


def respondent_bitmaps(rows: DataFrame, keys: Sequence[str], numbers: DataFrame, number: str = "DN") -> DataFrame:
    """One bitmap per combination of ``keys`` and range of respondents: (keys, bucket, bitmap).

    The only step that sees raw rows; a number counts once however often it occurs, and is folded
    into the bitmaps on the map side. Bitmaps of several rounds or batches add up by ``merge_bitmaps``.
    Rows without a number keep their keys, with an empty bitmap in bucket 0.
    """
    dense = rows.select(*keys, number).join(numbers, number, "left")
    return dense.groupBy(*keys, F.expr("coalesce(bitmap_bucket_number(respondent), 0)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(respondent)) FILTER (WHERE respondent IS NOT NULL)").alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer keys, or of several tables united: exact, because bits are respondents."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_levels(bitmaps: DataFrame, levels: Mapping[str, Sequence[str]], out: str = "respondents") -> DataFrame:
    """Distinct respondents of every level: (level, all key columns, ``out``), NULL in keys above it.

    Each level is merged from the bitmaps, never from the rows, so no level costs a distinct count.
    A stored table of bitmaps serves any further levels.
    """
    columns = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    kinds = {c: bitmaps.schema[c].dataType for c in columns}
    parts = []
    for name, keys in levels.items():
        merged = merge_bitmaps(bitmaps, keys)
        counts = merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias(out))
        parts.append(counts.select(F.lit(name).alias("level"), *[
            (F.col(c) if c in keys else F.lit(None).cast(kinds[c])).alias(c) for c in columns], out))
    return union_all(parts)


def percentiles(rows: DataFrame, value: str, levels: Mapping[str, Sequence[str]], shares: Sequence[float],
                bins: int = BINS) -> DataFrame:
    """Exact percentiles of a number at several levels: (level, key columns, n, one column ``p<share>``).

    The value at rank ceil(share * n) of the group's values in order, as SQL's PERCENTILE_DISC; NULL
    and NaN values do not count, and a group without others has no row. Share 0 is the least value.

    Selection by refining histograms: each round counts the values of a group per bin of its
    interval, finds the bin that holds the rank, and goes on with that bin, from its least to its
    greatest value. A rank is found when these agree. Rows are first counted per value and finest
    key; no group is ever gathered or sorted in one task, and each round reads only bins still open.
    """
    columns = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    found = F.col(value).cast("double")
    base = rows.where(found.isNotNull() & ~F.isnan(found)).groupBy(*columns, found.alias("v")).agg(F.count("*").alias("w"))
    base = materialise(base, "values")
    names = [f"p{format(s * 100, 'g').replace('.', '_')}" for s in shares]
    kinds = {c: rows.schema[c].dataType for c in columns}
    levelled = union_all([
        base.groupBy(*keys, "v").agg(F.sum("w").alias("w")).select(
            F.lit(name).alias("level"), *[(F.col(c) if c in keys else F.lit(None).cast(kinds[c])).alias(c) for c in columns], "v", "w")
        for name, keys in levels.items()])
    group = F.xxhash64("level", *columns).alias("g"), F.xxhash64(F.lit(1), "level", *columns).alias("h")
    values = materialise(levelled.select(*group, "level", *columns, "v", "w"), "levelled")
    sizes = materialise(values.groupBy("g", "h", "level", *columns).agg(
        F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "sizes")
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.lit(s) * F.col("n"))).cast("long").alias("rank"))
                      for i, s in enumerate(shares)])
    # One open search per group and distinct interval; those that share an interval share its histogram.
    open_ = materialise(sizes.select("g", "h", "low", "high", F.explode(ranks).alias("r")).select("g", "h", "low", "high", "r.i", "r.rank"), "open")
    done = []
    while True:
        done.append(open_.where("low = high").select("g", "h", "i", F.col("low").alias("v")))
        rest = open_.where("low < high")
        if rest.isEmpty():
            break
        spans = rest.select(F.struct("g", "h").alias("of"), "low", "high").distinct()
        # Joined by another key than is grouped by: rows of a large group are then counted where they
        # lie, and only counts per bin meet.
        inside = values.select("g", "h", "v", "w").join(broadcast_if_small(spans), F.struct("g", "h") == F.col("of")).where("v BETWEEN low AND high")
        place = f"least({bins - 1}, CAST(floor((v / 2 - low / 2) / (high / 2 - low / 2) * {bins}) AS INT))"
        # A step below the resolution of doubles would put all in one bin: the least value is a bin of its own.
        place = f"CASE WHEN v = low THEN -1 WHEN v = high THEN {bins} ELSE {place} END"
        counts = inside.withColumn("bin", F.expr(place)).groupBy("g", "h", "low", "high", "bin").agg(
            F.sum("w").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        listed = counts.groupBy("g", "h", "low", "high").agg(F.sort_array(F.collect_list(F.struct("bin", "c", "least", "most"))).alias("b"))
        joined = rest.join(listed, ["g", "h", "low", "high"])
        # At most bins + 2 entries: the first whose counts, added up, reach the rank.
        scan = """aggregate(b, named_struct('left', rank, 'least', CAST(NULL AS DOUBLE), 'most', CAST(NULL AS DOUBLE)),
            (s, x) -> CASE WHEN s.least IS NOT NULL THEN s
                WHEN s.left > x.c THEN named_struct('left', s.left - x.c, 'least', s.least, 'most', s.most)
                ELSE named_struct('left', s.left, 'least', x.least, 'most', x.most) END)"""
        open_ = materialise(joined.withColumn("s", F.expr(scan)).select(
            "g", "h", F.col("s.least").alias("low"), F.col("s.most").alias("high"), "i", F.col("s.left").alias("rank")), "open")
    wide = union_all(done).groupBy("g", "h").agg(*[F.max(F.when(F.col("i") == k, F.col("v"))).alias(c) for k, c in enumerate(names)])
    return sizes.join(wide, ["g", "h"]).select("level", *columns, "n", *names)
