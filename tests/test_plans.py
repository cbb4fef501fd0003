"""What the plans must and must not hold, and how hot keys behave."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

import oracle
from procurelytics.operators import ranking, risk, rollups
from procurelytics.plans import bindings
from procurelytics.plans.catalog import QUERIES
from procurelytics.sources import payloads

FOLDER = f"{oracle.TESTDATA}/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
GROUPED = {"forecast_fourier", "forecast_cv", "forecast_ar", "forecast_arima", "forecast_changepoints"}
FITS = {"forecast_rf", "forecast_rf_recursive", "rf_intervals", "rf_importance", "permutation_importance", "shap_importance", "shap_values"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FITS])
def test_plan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text
    if name not in GROUPED:
        assert "InPandas" not in text


def test_source_avoids_what_does_not_scale():
    banned = r"localCheckpoint|crossJoin|\.collect\(\)|toPandas|\bbroadcast\(|\.rdd\b|F\.udf|\.cache\(\)|\.persist\("
    library = glob.glob(f"{ROOT}/procurelytics/*.py") + glob.glob(f"{ROOT}/procurelytics/[!l]*/**/*.py", recursive=True)
    assert len(library) > 30
    for path in library:
        with open(path) as f:
            found = re.search(banned, f.read())
        assert found is None, (path, found)


def test_pruning_and_pushdown(spark):
    text = plan(rollups.subaward_monthly(bindings.subawards(spark, FOLDER, category=False).withColumn("sub_awardee_name", F.col("sub_awardee_key"))))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text
    text = plan(bindings.contracts(spark, FOLDER).where("obligated_amount > 400000"))
    assert "GreaterThan(o_totalprice,400000.0)" in text


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows."""
    rows = spark.range(90_000, numPartitions=8)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return rows.select(key.alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))


def partial_before_shuffle(df):
    """An aggregate below every exchange that a grouped query needs."""
    lines = plan(df).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return any("partial_" in line or "WindowGroupLimit" in line for line in lines[exchange + 1:])


def test_hot_keys_shrink_before_the_shuffle(hot):
    first = payloads.dedupe_first(hot, ["k"], "o")
    newest = ranking.latest_per(hot, "k", "o")
    two = ranking.latest_per(hot, "k", "o", n=2)
    spend = risk.supplier_concentration(hot, "k", "o", "v")
    for df in (first, newest, two, spend):
        assert partial_before_shuffle(df)
    assert first.where("k = 0").first().o == 0 and newest.where("k = 0").first().o == 89_997
    assert first.count() == 60_001 and two.where("k = 0").count() == 2
    assert spend.where("k = 0").first().num_suppliers == 30_000


def test_tail_is_a_distributed_top_k(hot):
    assert "TakeOrderedAndProject" in plan(ranking.tail_n(hot, 3, order="o").select("o")) or "limit=3" in plan(ranking.tail_n(hot, 3, order="o"))
    assert sorted(r.o for r in ranking.tail_n(hot, 3, order="o").collect()) == [89_997, 89_998, 89_999]
