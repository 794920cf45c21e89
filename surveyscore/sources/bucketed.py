"""Responses stored by number, so that later passes over numbers have no exchange.

A bucketed table keeps the rows of a number in one bucket, sorted. De-duplication across branches,
excluded numbers, and joins of two such tables on the number then work bucket by bucket: Spark reads
the table as already partitioned by the number, and every further key only makes that finer.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from surveyscore.operators.dedup import latest_per_key
from surveyscore.sources.sinks import drop_table, fresh_folder, remove_folder


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_by_number(df: DataFrame, name: str | None = None, path: str | None = None, buckets: int | None = None,
                    number: str = "DN", sort: Sequence[str] = ()) -> DataFrame:
    """Store rows as a table in ``buckets`` by ``number`` and read it back.

    ``path`` is a folder that all executors reach, a fresh one below ``spark.checkpoint.dir`` by
    default; ``name`` the table's name in the catalog. Tables to be joined without an exchange need
    the same number of buckets. Rows are dealt to their buckets before they are written, so a bucket
    is one file; NULL numbers share a bucket, and so do all rows of one number: store rows that are
    de-duplicated per branch, of which no number has many.
    """
    spark = df.sparkSession
    n = buckets or default_buckets(spark)
    table = name or f"responses_{uuid.uuid4().hex}"
    drop_table(spark, table)
    order = [number, *[c for c in sort if c != number]]
    (df.repartition(n, number).write.format("parquet").mode("overwrite").bucketBy(n, number).sortBy(*order)
     .option("path", path or fresh_folder(spark, "bucketed")).saveAsTable(table))
    return spark.table(table)


def drop_by_number(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Forget a stored table and, if its folder is given, remove that."""
    drop_table(spark, name)
    if path:
        remove_folder(spark, path)


def latest_of_number(stored: DataFrame, keys: Sequence[str], order: str = "Start_Time", tie=None) -> DataFrame:
    """``latest_per_key`` by the number and further keys, within buckets."""
    return latest_per_key(stored, ["DN", *[k for k in keys if k != "DN"]], order, tie)
