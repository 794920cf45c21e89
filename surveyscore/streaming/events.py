"""Events and calls as streams of files: the batch results, as far as files have arrived.

Both forms read what is new in a folder and stop (``availableNow``), so they are run again as often
as wanted; checkpoints in the shared folder say what has been read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore.operators.dedup import latest_per_key
from surveyscore.plans import incremental


@dataclass(frozen=True)
class Progress:
    """What a run of a stream did: rows read, rows too late to count, batches."""

    rows: int
    late: int
    batches: int


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> Progress:
    seen = {"rows": 0, "late": 0, "batches": 0}
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(each).start())
    query.awaitTermination()
    for p in query.recentProgress:
        seen["rows"] += max(p["numInputRows"], 0)
        seen["late"] += sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
        seen["batches"] += p["numInputRows"] > 0
    return Progress(**seen)


def _files(spark: SparkSession, folder: str, schema: T.StructType, per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def count_windows(spark: SparkSession, folder: str, schema: T.StructType, target: str, width: str = "1 day",
                  delay: str = "30 days", at: str = "ts", number: str = "event_id", by: str = "event_type",
                  value: str = "value", files_per_batch: int = 4) -> Progress:
    """Events per window and kind: n, total. Changed windows are appended to ``target`` by batch.

    An event (by its number) counts once, whichever of its copies comes first within ``delay``. An
    event older than the watermark, ``delay`` behind the latest one of earlier batches, can no longer
    be told from a copy; it is left out and counted in the progress. ``read_windows`` gives the
    standing result. A batch that runs again after a failure replaces its own rows.
    """
    stamp = schema[at].dataType
    rows = _files(spark, folder, schema, files_per_batch)
    if not isinstance(stamp, T.TimestampType):
        rows = rows.withColumn(at, F.col(at).cast("timestamp"))  # a watermark needs an instant
    rows = rows.where(F.col(at).isNotNull()).withWatermark(at, delay).dropDuplicatesWithinWatermark([number])
    counts = rows.groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    flat = counts.select(F.col("w.start").alias("window_start"), by, "n", "total")

    def keep(batch: DataFrame, number_of_batch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch={number_of_batch}")

    return _run(flat, keep, f"{target}/checkpoint", "update")


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    """The latest state of every window: window_start, kind, n, total."""
    changes = spark.read.parquet(f"{target}/changes")
    keys = changes.columns[:2]
    return latest_per_key(changes, keys, order="batch", tie=["n"]).drop("batch")


def stream_calls(spark: SparkSession, folder: str, schema: T.StructType, store: str, specs, books=None, geo=None, geo_remap=None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 4) -> Progress:
    """Scores kept up to date from files of raw calls, through ``incremental.update``.

    Calls may come late by any time and more than once: the store decides by time and call id, so no
    row is ever too late, and a batch that runs again after a failure changes nothing.
    """
    def take(batch: DataFrame, _: int) -> None:
        incremental.update(store, prepare(batch) if prepare else batch, specs, books, geo, geo_remap)

    return _run(_files(spark, folder, schema, files_per_batch), take, f"{store}/checkpoint", "append")
