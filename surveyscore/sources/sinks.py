"""Sinks: JDBC, CSV, and stored tables that later steps read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from surveyscore.sources.readers import JdbcOptions

BATCH_ROWS = 10_000  # fixed value: rows per insert batch


def jdbc_write_options(opts: JdbcOptions, table: str, batchsize: int = BATCH_ROWS,
                       num_partitions: int | None = None, truncate: bool = False) -> dict[str, str]:
    out = {**opts.connection(), "dbtable": table, "batchsize": str(batchsize)}
    if num_partitions is not None:
        out["numPartitions"] = str(num_partitions)
    if truncate:
        out["truncate"] = "true"
    return out


def write_jdbc(df: DataFrame, table: str, opts: JdbcOptions, mode: str = "overwrite",
               batchsize: int = BATCH_ROWS, num_partitions: int | None = None,
               truncate: bool = False) -> None:
    """Replace (or append to) a database table in batches. A failure raises."""
    options = jdbc_write_options(opts, table, batchsize, num_partitions, truncate)
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header, written by all tasks; one file only when asked for."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists. The name may be qualified; each part is quoted."""
    parts = [p.strip("`") for p in name.split(".")]
    quoted = ".".join("`" + p.replace("`", "``") + "`" for p in parts)
    spark.sql(f"DROP TABLE IF EXISTS {quoted}")


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def materialise(df: DataFrame, name: str | None = None, path: str | None = None,
                partition_by=()) -> DataFrame:
    """Store a result as parquet and read it back, which also ends its lineage.

    The target is ``path``, or a fresh sub-folder of the shared folder, which goes when the
    session's file system closes; ``drop_stored`` removes it sooner.
    """
    spark = df.sparkSession
    target = path or fresh_folder(spark, name or "result")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def _file_system(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def drop_stored(df: DataFrame) -> None:
    """Remove the folder of a frame that ``materialise`` returned."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        files, at = _file_system(df.sparkSession, folder)
        files.delete(at, True)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the session's file system closes."""
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, at = _file_system(spark, target)
    files.deleteOnExit(at)
    return target


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def save_scores(df: DataFrame, path: str, replace_all: bool = False) -> None:
    """Store score rows partitioned by round and state, so reports prune to what they show.

    Only the rounds and states that ``df`` holds are replaced; ``replace_all`` empties the folder.

    The rebalance hint lets AQE merge small partitions and split a heavy state over tasks.
    """
    by = [c for c in ("ROUND", "state") if c in df.columns]
    kind = "static" if replace_all else "dynamic"
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy(*by).parquet(path)
