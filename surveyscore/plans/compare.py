"""Two stored runs compared: rows added, removed and changed, with their multiplicities.

Runs are stored by part (round and state), each with a digest of its rows. Parts whose digests agree
hold the same rows and are not read again; the rows of the others meet with signs +1 and -1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyscore import schema as S
from surveyscore.operators.combine import union_all
from surveyscore.sources.sinks import folder_exists, save_scores

PARTS = ("ROUND", "state")


def _fingerprint(df: DataFrame, seed: int):
    """A 64-bit digest of a row: every column by name, NULL told from every value."""
    columns = sorted(df.columns)
    known = [F.col(f"`{c}`").isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], *known)


def part_digests(df: DataFrame, by=PARTS) -> DataFrame:
    """Rows and digest of each part: sums over its rows, so order and files do not matter.

    Two independent 64-bit sums; sums keep multiplicities, which an exclusive or would lose.
    """
    wide = [F.sum(_fingerprint(df, k).cast("decimal(38,0)")).alias(f"digest_{k}") for k in (1, 2)]
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *wide)


def save_run(df: DataFrame, path: str) -> None:
    """Store a run's score rows and the digests of its parts, to be compared with other runs."""
    save_scores(df, f"{path}/rows", replace_all=True)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    part_digests(stored.select(*df.columns)).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def read_run(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def changed_parts(spark: SparkSession, old: str, new: str, by=PARTS) -> list[tuple]:
    """Parts whose rows differ, from the digests alone. As many at most as there are parts."""
    for path in (old, new):
        if not folder_exists(spark, f"{path}/digests"):
            raise ValueError(f"no stored run at {path}")
    signed = union_all([spark.read.parquet(f"{p}/digests").withColumn("sign", F.lit(s)) for p, s in ((old, -1), (new, 1))])
    cells = [c for c in signed.columns if c != "sign"]
    open_ = signed.groupBy(*cells).agg(F.sum("sign").alias("n")).where("n <> 0")
    return sorted((tuple(r) for r in open_.select(*by).distinct().collect()), key=repr)


def bag_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur more often in one table than in the other: all columns and ``n``.

    ``n`` is how many more there are in ``new`` (negative: in ``old``). NULLs are equal to NULLs.
    Equal rows are added up before the exchange, so one row that is a third of a table costs little.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the tables have other columns")
    signed = old.withColumn("n", F.lit(-1).cast("long")).unionByName(new.withColumn("n", F.lit(1).cast("long")))
    return signed.groupBy(*[f"`{c}`" for c in old.columns]).agg(F.sum("n").alias("n")).where("n <> 0")


def classify(difference: DataFrame, keys=(*S.ROW_KEYS, "ROUND")) -> DataFrame:
    """A bag difference with ``change``: added, removed, or changed where a key has rows of both signs."""
    sides = difference.groupBy(*keys).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = [F.col(k).alias(f"__{k}") for k in keys]
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = difference.join(sides.select(*other, "low", "high"), same)
    kind = F.when(F.col("low") * F.col("high") < 0, "changed").when(F.col("n") > 0, "added").otherwise("removed")
    return joined.select(*difference.columns, kind.alias("change"))


def compare_runs(spark: SparkSession, old: str, new: str) -> DataFrame:
    """What differs between two stored runs: their rows, ``n`` and ``change``. Equal parts are not read."""
    parts = changed_parts(spark, old, new)
    before, after = read_run(spark, old), read_run(spark, new)
    only = F.lit(False)
    for values in parts:
        test = F.lit(True)
        for c, v in zip(PARTS, values):
            test = test & F.col(c).eqNullSafe(F.lit(v))
        only = only | test
    return classify(bag_difference(before.where(only), after.where(only).select(*before.columns)))
