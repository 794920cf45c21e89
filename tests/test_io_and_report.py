import pytest
from conftest import rows
from pyspark.sql import functions as F

from surveyscore.plans import report
from surveyscore.schema import GEO_SCHEMA, SchemaError
from surveyscore.sources import readers, sinks
from surveyscore.sources.readers import JdbcOptions

OPTS = JdbcOptions("jdbc:x://host/db", driver="d", user="someone", password="secret")


def test_jdbc_options():
    assert OPTS.reading() == {"url": "jdbc:x://host/db", "driver": "d", "user": "someone", "password": "secret", "fetchsize": "10000"}
    assert "someone" not in repr(OPTS) and "secret" not in repr(OPTS)
    split = JdbcOptions("jdbc:x", partition_column="AC_NO", lower_bound=1, upper_bound=300, num_partitions=64).reading()
    assert split["partitionColumn"] == "AC_NO" and split["numPartitions"] == "64"
    with pytest.raises(ValueError):
        JdbcOptions("jdbc:x", partition_column="AC_NO").reading()
    out = sinks.jdbc_write_options(OPTS, "scores", num_partitions=8, truncate=True)
    assert out["batchsize"] == "10000" and out["dbtable"] == "scores" and out["truncate"] == "true"
    assert readers.derived_table(" SELECT 1; ") == "(SELECT 1) AS q"


def test_jdbc_settings_come_from_the_environment(monkeypatch):
    with pytest.raises(ValueError):
        JdbcOptions.from_env()
    monkeypatch.setenv("SURVEY_JDBC_URL", "jdbc:y")
    assert JdbcOptions.from_env(fetchsize=5).reading() == {"url": "jdbc:y", "fetchsize": "5"}


def test_failed_write_raises(spark):
    with pytest.raises(Exception):
        sinks.write_jdbc(spark.range(1), "t", JdbcOptions("jdbc:none://nowhere"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S", 1), ("T", 2)], GEO_SCHEMA)
    for single in (False, True):
        path = str(tmp_path / f"csv{single}")
        sinks.write_csv(df, path, single_file=single)
        assert rows(readers.read_csv(spark, path, GEO_SCHEMA)) == [("S", 1), ("T", 2)]
        assert rows(readers.read_dim(spark, path, GEO_SCHEMA, "csv"), "AC_ID") == [("S-AC-1",), ("T-AC-2",)]


def test_parquet_is_checked(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("S", 1, 2)], "State_Code string, AC_NO int, x int").write.parquet(path)
    assert readers.read_parquet(spark, path, GEO_SCHEMA).columns == ["State_Code", "AC_NO"]
    with pytest.raises(SchemaError):
        readers.read_parquet(spark, path, readers.S.REGION_SCHEMA)


def test_materialise_and_stored_scores(spark, tmp_path):
    df = spark.createDataFrame([("S", "BC", 1), ("S", "EP", 2), ("T", "BC", 3)], "state string, ROUND string, n int")
    kept = sinks.materialise(df, "x")
    assert rows(kept) == rows(df)
    assert sinks.shared_folder(spark) in kept.inputFiles()[0]
    sinks.save_scores(df, str(tmp_path / "scores"))
    stored = spark.read.parquet(str(tmp_path / "scores"))
    plan = stored.filter("ROUND = 'BC' AND state = 'T'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ROUND" in plan and stored.count() == 3
    sinks.drop_stored(kept)
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0].rsplit("/", 1)[0]).count()


def test_saving_one_round_keeps_the_others(spark, tmp_path):
    df = spark.createDataFrame([("S", "BC", 1), ("S", "EP", 2), ("T", "BC", 3)], "state string, ROUND string, n int")
    path = str(tmp_path / "scores")
    for name in ("BC", "EP"):
        sinks.save_scores(df.filter(F.col("ROUND") == name), path)
    assert rows(spark.read.parquet(path), "n") == [(1,), (2,), (3,)]
    sinks.save_scores(df.filter("ROUND = 'EP'").withColumn("n", F.lit(7)), path)
    assert rows(spark.read.parquet(path), "n") == [(1,), (3,), (7,)]
    sinks.save_scores(df.filter("ROUND = 'EP'"), path, replace_all=True)
    assert rows(spark.read.parquet(path), "n") == [(2,)]


def test_the_shared_folder_must_be_named():
    class Unnamed:
        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError):
        sinks.shared_folder(Unnamed)


def test_drop_table(spark):
    spark.range(3).write.saveAsTable("old_scores")
    sinks.drop_table(spark, "old_scores")
    sinks.drop_table(spark, "default.old_scores")
    assert not spark.catalog.tableExists("old_scores")


def test_tally_counts_while_reading(spark):
    df, seen = readers.with_tally(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7
    assert report.preview(spark.range(50)).count() == 10


def test_read_many(spark):
    a, b = spark.range(2), spark.range(3)
    assert readers.read_many({"a": a, "b": b}).count() == readers.read_many([a, b]).count() == 5


@pytest.fixture(scope="module")
def scores(spark):
    data = [("S", i % 12, x, r, f"S-AC-{i % 12}") for i in range(12) for x in "AB" for r in ("BC", "EP")]
    data += [("T", 3, "A", "BC", "T-AC-3"), ("T", None, None, "BC", None)]
    return spark.createDataFrame(data, "state string, AC_NO int, RES1 string, ROUND string, AC_ID string")


def test_pages_cover_everything_once(scores):
    pages = [[tuple(r) for r in report.page_rows(scores, p, size=20).collect()] for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [20, 20, 10]
    assert sum(pages, []) == [tuple(r) for r in report.sort_rows(scores).collect()]


@pytest.mark.parametrize("page,shown", [(1, 1), (4, 4), (99, 4), (0, 4), (-2, 4), ("x", 1), (None, 1), ("3", 3)])
def test_page_number_is_clamped(page, shown):
    assert report.clamp_page(page, 4) == shown


def test_page_count():
    assert [report.page_count(n) for n in (0, 1, 30, 31)] == [1, 1, 1, 2]


def test_report(scores):
    r = report.report(scores, page="2", size=20, state="S", round="")
    assert (r.total, r.pages) == (48, 3)
    assert [x.AC_NO for x in r.ac_numbers.collect()] == list(range(12))
    assert [x.state for x in r.states.collect()] == ["S", "T"]
    assert [x.RES1 for x in r.parties.collect()] == ["A", "B"]
    assert r.rows.count() == 20
    assert report.report(scores).ac_numbers.count() == 0
    empty = report.report(scores.filter("RES1 IS NULL"))
    assert empty.parties.count() == 0
    assert report.slice_rows(scores, state="S", ac_no="3", res1="A", round="EP").count() == 1
