import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("surveyscore-tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def calls(spark, data, **fixed):
    """Raw calls from partial dicts; missing columns are NULL."""
    import datetime

    from surveyscore.schema import RAW_SCHEMA

    out = []
    for i, d in enumerate(data):
        row = {f.name: None for f in RAW_SCHEMA}
        row.update(Campaign_Name="AP-EP-PC1", N_PARTY="ABO", AC_NO=1, PC_NO=1, state="Andhra")
        row.update(fixed)
        row.update(d)
        day = row["Start_Time"]
        if isinstance(day, int):
            row["Start_Time"] = datetime.datetime(2024, 1, day)
        out.append(tuple(row[f.name] for f in RAW_SCHEMA))
    return spark.createDataFrame(out, RAW_SCHEMA)
