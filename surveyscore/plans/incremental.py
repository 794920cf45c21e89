"""Scores kept up to date from batches of new calls.

A store is a folder with two tables, both partitioned by round and state:

* ``numbers``: for every number and branch, the call (or column-wise maximum) that counts now;
* ``counts``: the pre-aggregate that all scopes, rounds and pools are scored from.

A batch changes what counts for the numbers it holds, and nothing else. Their rows are built into
responses twice, as they were and as they are now; the old ones leave the pre-aggregate with sign
-1, the new ones enter with +1. That covers every rule of a round, also those that look across the
branches of a state, because these never look beyond one number. The rest of a part is copied, other
parts are neither read nor written.

Batches may come in any order and more than once: what counts is decided by time and call id, and a
call that is there already changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore import schema as S
from surveyscore.operators import scoring
from surveyscore.operators.combine import union_all
from surveyscore.operators.decode import Codebook
from surveyscore.plans import rounds
from surveyscore.plans.spec import StateRoundSpec
from surveyscore.rules import rule_table
from surveyscore.sources.sinks import drop_stored, folder_exists, materialise, remove_folder

NUMBERS, COUNTS = "numbers", "counts"
PART = ("ROUND", "part")  # part: the state of the spec
KEYS = [*S.ROW_KEYS, "AC_NO", "PC_NO", "state"]

_SPECS = T.StructType([T.StructField("branch_id", T.StringType()), T.StructField("spec", T.StringType()),
                       T.StructField("ROUND", T.StringType()), T.StructField("part", T.StringType())])


def _spec_rows(specs: list[StateRoundSpec]):
    return [(b.branch_id, s.key, s.round, s.state) for s in specs for b in s.branches]


def _collapse(calls: DataFrame) -> DataFrame:
    """One row per number and branch, by the rule of the branch."""
    out = []
    for style in ("latest", "colmax"):
        own = calls.where(F.col("style") == style).drop("style")
        own = own.drop("CALL_ID") if style == "colmax" else own
        out.append(rounds.collapse(own, style, by="branch_id").withColumn("style", F.lit(style)))
    return out[0].unionByName(out[1], allowMissingColumns=True).select(*calls.columns)


def _of_batch(batch: DataFrame, specs: list[StateRoundSpec]) -> DataFrame:
    """The batch's own part of ``numbers``."""
    S.require(batch, ["CALL_ID"], "a batch")
    numbers = {b.branch_id: k for k, b in enumerate(b for s in specs for b in s.branches)}
    names = F.create_map(*[F.lit(x) for b, k in numbers.items() for x in (k, b)])
    out = []
    for style in ("latest", "colmax"):
        group = [b for s in specs for b in s.branches if b.dedup == style]
        if group:
            calls = rounds.collapse(rounds.tagged_calls(batch, group, numbers, style), style)
            calls = calls.withColumns({"branch_id": names[F.col(rounds.BRANCH)], "style": F.lit(style)})
            if style == "colmax":
                calls = calls.withColumn("CALL_ID", F.lit(None).cast(batch.schema["CALL_ID"].dataType))
            out.append(calls.drop(rounds.BRANCH))
    rows = union_all(out)
    return rows.join(rule_table(batch.sparkSession, _spec_rows(specs), _SPECS), "branch_id").drop("spec")


def _table(spark: SparkSession, path: str, name: str, schema: T.StructType, parts: list[tuple]) -> DataFrame:
    """The stored rows of some parts."""
    if not folder_exists(spark, f"{path}/{name}"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/{name}")
    return rows.where(_in(parts))


def _in(parts: list[tuple]) -> Column:
    tests = [(F.col("ROUND") == r) & (F.col("part") == p) for r, p in parts]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _change(rows: DataFrame, sign: int, specs, books, geo, remap) -> DataFrame:
    """Signed counts of the responses that rows of ``numbers`` are built into."""
    numbers = {b.branch_id: k for k, b in enumerate(b for s in specs for b in s.branches)}
    number = F.create_map(*[F.lit(x) for b, k in numbers.items() for x in (b, k)])
    calls = rows.withColumn(rounds.BRANCH, number[F.col("branch_id")]).drop("branch_id", "style", "CALL_ID", *PART)
    made = rounds._finish(calls, specs, books, geo, remap, carry=("__spec",))
    parts = rule_table(rows.sparkSession, [(s.key, s.state) for s in specs],
                       T.StructType([T.StructField("__spec", T.StringType()), T.StructField("part", T.StringType())]))
    return made.join(parts, "__spec").select(
        *PART, *KEYS, (F.lit(sign) * F.col("DN").isNotNull().cast("long")).alias("__n"), F.lit(sign).cast("long").alias("__rows"))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PART, *KEYS).agg(F.sum("__n").alias("__n"), F.sum("__rows").alias("__rows"))


def update(path: str, batch: DataFrame, specs: list[StateRoundSpec], books: Codebook | None = None,
           geo: DataFrame | None = None, geo_remap: DataFrame | None = None) -> list[tuple]:
    """Take a batch of raw calls (with CALL_ID) into the store at ``path``; the parts it changed.

    ``specs`` must be those that the store was filled with. New contents are written beside the
    store first and take the place of the old ones after that, part by part. An update that is cut
    short in between is completed by the next one, or by ``complete``.
    """
    spark = batch.sparkSession
    complete(spark, path)
    books = Codebook() if books is None else books
    fresh = materialise(_of_batch(batch, specs), "batch")
    parts = [tuple(r) for r in fresh.select(*PART).distinct().collect()]  # at most one per spec
    if not parts:
        return []
    own = [s for s in specs if (s.round, s.state) in parts]
    stored = _table(spark, path, NUMBERS, fresh.schema, parts)
    hit = fresh.select("DN", *PART).distinct().select(F.col("DN").alias("d"), F.col("ROUND").alias("r"), F.col("part").alias("p"))
    same = F.col("DN").eqNullSafe(F.col("d")) & (F.col("ROUND") == F.col("r")) & (F.col("part") == F.col("p"))
    before = materialise(stored.join(hit, same, "left_semi"), "before")
    after = materialise(_collapse(before.unionByName(fresh)), "after")
    change = _summed(_change(after, 1, own, books, geo, geo_remap).unionByName(
        _change(before, -1, own, books, geo, geo_remap)))
    # Keys that nobody holds any more stay with a count of 0, so that no part is ever without rows.
    counts = _summed(_table(spark, path, COUNTS, change.schema, parts).unionByName(change))
    rows = stored.join(hit, same, "left_anti").unionByName(after)
    for name, df in ((NUMBERS, rows), (COUNTS, counts)):
        df.hint("rebalance", *PART).write.mode("overwrite").partitionBy(*PART).parquet(f"{path}/pending/{name}")
    spark.createDataFrame([(len(parts),)], "parts int").coalesce(1).write.mode("overwrite").parquet(f"{path}/pending/ready")
    complete(spark, path)
    for df in (fresh, before, after):
        drop_stored(df)
    return sorted(parts)


def complete(spark: SparkSession, path: str) -> bool:
    """Bring written contents into place; those of an update that never got so far are dropped.

    May be repeated: what is pending holds whole parts, and is removed last.
    """
    ready = folder_exists(spark, f"{path}/pending/ready/_SUCCESS")
    if ready:
        for name in (NUMBERS, COUNTS):
            (spark.read.parquet(f"{path}/pending/{name}").hint("rebalance", *PART).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*PART).parquet(f"{path}/{name}"))
        remove_folder(spark, f"{path}/pending/ready")
    remove_folder(spark, f"{path}/pending")
    return ready


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """The pre-aggregate of all rounds, for ``scoring.score_base`` and ``scoring.pooled_base``."""
    rows = spark.read.parquet(f"{path}/{COUNTS}")
    return rows.where("__rows > 0").drop("__rows", "part")


def stored_scores(spark: SparkSession, path: str, pooled: str | None = "COM", scopes=tuple(S.SCOPES)) -> DataFrame:
    """Score rows of every stored round and, unless ``pooled`` is None, of all of them together."""
    base = stored_counts(spark, path)
    return scoring.score_base(scoring.pooled_base(base, pooled) if pooled else base, scopes, ("ROUND",))
