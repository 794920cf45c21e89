"""Geography and region lookups, and number exclusion.

Dimension frames are counted before they are broadcast. One beyond the bound is joined by a
shuffle, where AQE splits a heavy constituency on the response side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore.functions import scalars as fn
from surveyscore.rules import broadcast_if_small


def _same_place(code: str):
    """AC numbers start anew in every state, so a place is a state and a number."""
    return (F.col(code) == F.col("__s")) & (F.col("AC_NO") == F.col("__a"))


def geo_check(df: DataFrame, geo: DataFrame, states, unique: bool = True, code: str = "STATE_CODE") -> DataFrame:
    """Keep rows whose state and AC number exist in the geography of ``states``.

    ``code`` is the column with a row's state. ``unique=False`` repeats a row for each matching
    geography row, as an inner join does.
    """
    dim = geo.filter(F.col("State_Code").isin(*states)).select(F.col("State_Code").alias("__s"), F.col("AC_NO").alias("__a"))
    dim = broadcast_if_small(dim.distinct() if unique else dim)
    return df.join(dim, _same_place(code), "left_semi" if unique else "inner").select(*df.columns)


def geo_remap(df: DataFrame, remap: DataFrame, states, code: str = "STATE_CODE") -> DataFrame:
    """Take the PC number and PC id from the geography, keyed by state and AC; drop unknown ACs."""
    dim = (
        remap.filter(F.col("State_Code").isin(*states))
        .select(F.col("State_Code").alias("__s"), F.col("AC_NO").alias("__a"), F.col("PC_No").alias("__pc"))
        .distinct()
    )
    out = df.drop("PC_NO", "PC_ID").join(broadcast_if_small(dim), _same_place(code))
    return (
        out.withColumn("PC_NO", F.col("__pc"))
        .withColumn("PC_ID", fn.pc_id("__s", "__pc"))
        .drop("__pc", "__s", "__a")
    )


def region_dim(region: DataFrame, keys=("AC_ID",), unique: bool = True) -> DataFrame:
    """Region map keyed by ``keys``: AC_ID, or AC_ID with PC_ID; one row per key by default."""
    dim = (
        region.withColumn("AC_ID", fn.ac_id("State_Code", "AC_NO"))
        .withColumnRenamed("PC_REGION", "REGION")
        .select(*keys, "REGION")
    )
    return dim.groupBy(*keys).agg(F.min("REGION").alias("REGION")) if unique else dim


def with_region(df: DataFrame, region: DataFrame, keys=("AC_ID",), unique: bool = True) -> DataFrame:
    """Left lookup: a row without a region is kept with REGION NULL."""
    return df.join(broadcast_if_small(region_dim(region, keys, unique)), list(keys), "left")


def exclude_numbers(df: DataFrame, numbers: DataFrame, key: str = "DN") -> DataFrame:
    """Drop rows whose number is listed. A NULL in the list removes nothing.

    The list is cut to distinct numbers first (with map-side combine), so a repeated number
    does not make one join partition heavy. Rows without a number match nothing; they are dealt
    out by a hash of the row instead of meeting in one partition.
    """
    listed = numbers.select(F.col(key).alias("__n")).where("__n IS NOT NULL").distinct()
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
    return df.join(listed, F.coalesce(F.col(key).cast("string"), spread) == F.col("__n").cast("string"), "left_anti")
