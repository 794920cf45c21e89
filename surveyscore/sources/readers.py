"""Sources: parquet, CSV and JDBC, with declared schemas."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore import schema as S
from surveyscore.functions import scalars as fn


@dataclass(frozen=True)
class JdbcOptions:
    """Connection settings. They come from the caller or the environment, never from code."""

    url: str
    driver: str | None = None
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    fetchsize: int = 10_000
    partition_column: str | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    num_partitions: int | None = None

    @classmethod
    def from_env(cls, prefix: str = "SURVEY_JDBC_", **more) -> JdbcOptions:
        env = {k: os.environ.get(prefix + k.upper()) for k in ("url", "driver", "user", "password")}
        if not env["url"]:
            raise ValueError(f"set {prefix}URL")
        return cls(**env, **more)

    def connection(self) -> dict[str, str]:
        pairs = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: v for k, v in pairs.items() if v is not None}

    def reading(self) -> dict[str, str]:
        out = {**self.connection(), "fetchsize": str(self.fetchsize)}
        parts = {
            "partitionColumn": self.partition_column, "lowerBound": self.lower_bound,
            "upperBound": self.upper_bound, "numPartitions": self.num_partitions,
        }
        given = {k: str(v) for k, v in parts.items() if v is not None}
        if given and len(given) != len(parts):
            raise ValueError("a parallel read needs partition_column, both bounds and num_partitions")
        return {**out, **given}


def derived_table(sql: str) -> str:
    """Query text as a derived table, which (unlike the ``query`` option) allows a parallel read."""
    return f"({sql.strip().rstrip(';')}) AS q"


def read_jdbc_query(spark: SparkSession, sql: str, opts: JdbcOptions, predicates=None) -> DataFrame:
    """Run ``sql`` in the database. ``predicates`` splits the read into one partition each."""
    if predicates:
        rest = {k: v for k, v in opts.reading().items() if k != "url"}
        return spark.read.jdbc(opts.url, derived_table(sql), predicates=list(predicates), properties=rest)
    return spark.read.format("jdbc").options(**opts.reading()).option("dbtable", derived_table(sql)).load()


def read_jdbc_table(spark: SparkSession, name: str, opts: JdbcOptions) -> DataFrame:
    return spark.read.format("jdbc").options(**opts.reading()).option("dbtable", name).load()


def read_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """CSV with a header. The schema is declared; nothing is inferred by a second read."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, checked for the declared columns and projected to them."""
    df = spark.read.parquet(path)
    return df if schema is None else S.require(df, schema.names, str(path)).select(*schema.names)


def read_many(frames) -> DataFrame:
    """Stack named results: frames, or a mapping of name to frame, by column name."""
    items = list(frames.values()) if isinstance(frames, Mapping) else list(frames)
    return reduce(lambda a, b: a.unionByName(b), items)


def read_many_queries(spark: SparkSession, sqls: Mapping[str, str], opts: JdbcOptions) -> DataFrame:
    return read_many({name: read_jdbc_query(spark, sql, opts) for name, sql in sqls.items()})


def scan_responses(df: DataFrame, campaign_prefix: str) -> DataFrame:
    """Calls of the campaigns with a prefix; the condition is pushed to the source."""
    return df.filter(F.col("Campaign_Name").startswith(campaign_prefix))


def read_dim(spark: SparkSession, path, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Geography or region table, with AC_ID added so it can be joined to responses."""
    df = read_csv(spark, path, schema) if fmt == "csv" else read_parquet(spark, path, schema)
    return df.withColumn("AC_ID", fn.ac_id("State_Code", "AC_NO"))


def with_tally(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they are read, at no extra pass; read ``.get["rows"]`` after an action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
