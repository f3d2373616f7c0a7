"""Every named query against its DuckDB twin."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry_points
from sensorflow.plans import catalogue, oracle

QUERIES = catalogue.queries()
TWINS = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, con, sf_dir):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(TWINS[name]).df()
    assert difference(ours, theirs) == ""


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


def test_entry_points_hold_them_all():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(TWINS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 361


def test_rounding_leaves_odd_numbers_alone(spark):
    from math import inf, isnan

    rows = spark.createDataFrame([(0, float("nan")), (1, inf), (2, -inf), (3, 1e13), (4, 1.23456789)], "i int, v double")
    got = [r.v for r in catalogue.comparable(rows).orderBy("i").collect()]
    assert isnan(got[0]) and got[1:] == [inf, -inf, 1e13, 1.234568]
