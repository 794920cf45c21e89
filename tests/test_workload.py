"""Every registered query against its SQL, on the smallest tables."""

import pytest

from workload.check import compare, duck
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF, name)
    assert ok, text


def test_report_slice_is_the_constituency_first_asked_for(spark, con):
    from workload.queries import _long

    rows = QUERIES["report_slice"](spark, SF).collect()
    assert rows and {(r.state, r.AC_NO) for r in rows} == {("EUROPE", 37)}
    assert len(rows) == _long(spark, SF).where("state = 'EUROPE' AND AC_NO = 37").count()
    assert len(con.execute(ORACLE["report_slice"]).fetchall()) == len(rows)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    own = {k for k in e.queries() if k != "pipeline" and not k.startswith("op")}
    assert own == set(QUERIES)
