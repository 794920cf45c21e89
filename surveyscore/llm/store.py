"""Intermediate tables in the shared folder: they end lineage and outlive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from surveyscore.sources.sinks import shared_folder


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back.

    The folder is removed when the session's file system closes.
    """
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(target)
