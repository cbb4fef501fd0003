"""Every registered query against its SQL on the smallest tables."""

import pytest

import oracle
from procurelytics.plans.catalog import ORACLES, QUERIES

FOLDER = f"{oracle.TESTDATA}/sf0.001"

@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, con, name):
    problem, *_ = oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 80
    assert set(e.oracle_sql()) <= set(e.queries())


def test_importances_sum_to_one(spark):
    total = QUERIES["rf_importance"](spark, FOLDER).agg({"importance": "sum"}).first()[0]
    assert abs(total - 1) < 0.01
