"""Rule tables (driver-held configuration as joinable frames) and the check before a broadcast.

Nothing is broadcast before its row count has been checked. A larger table is still joined, with
the join strategy left to Spark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_RULE_ROWS = 200_000
MAX_DIM_ROWS = 500_000  # rows of a dimension of a few short columns: some tens of megabytes


def rule_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Local relation of ``rows``; marked for broadcast when within the checked bound."""
    rows = list(rows)
    arrow = pa.Table.from_pylist(
        [dict(zip(schema.names, r)) for r in rows], schema=to_arrow_schema(schema)
    )
    df = spark.createDataFrame(arrow, schema=schema)
    return F.broadcast(df) if len(rows) <= MAX_RULE_ROWS else df


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Mark a dimension for broadcast after counting it; leave a larger one to a shuffled join.

    The count is a job over the dimension alone. Without it a dimension that is itself computed
    has no useful size estimate, and the large side would be shuffled before AQE can tell.
    """
    bound = MAX_DIM_ROWS if max_rows is None else max_rows
    return F.broadcast(df) if df.count() <= bound else df
