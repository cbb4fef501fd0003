"""Places in the order of a whole table against the plain window."""

import random

from pyspark.sql import Window, functions as F

from procurelytics.operators import ordering


def table(spark, n=3000):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "hot", "hot", "hot"]), rng.choice([None, *range(40)]), rng.choice([None, 1.0, 2.5])) for _ in range(n)]
    return spark.createDataFrame(rows, "k string, v int, w double")


def check(spark, by):
    df = table(spark)
    got = ordering.in_order(df, F.col("v").desc(), by=by, running=["w"])
    window = Window.partitionBy(*([by] if by else [F.lit(0)])).orderBy(F.col("v").desc())
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.select("k", "v", F.rank().over(window).alias("rank"), F.count("*").over(whole).alias("n_rows"), F.percent_rank().over(window).alias("p"), F.sum("w").over(whole).alias("total_w"))
    out = got.withColumn("p", ordering.percent_rank(got))
    assert sorted(map(repr, out.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    for key, rows in groups(out, by).items():
        rows.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
        total = 0.0
        for r in rows:
            total += r["w"] or 0.0
            assert abs(r["running_w"] - total) < 1e-6


def groups(df, by):
    out = {}
    for r in df.collect():
        out.setdefault(r[by] if by else None, []).append(r)
    return out


def test_whole_table(spark):
    check(spark, None)


def test_keys_with_a_hot_one_and_nulls(spark):
    check(spark, "k")


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "k string, v int, w double")
    assert ordering.in_order(empty, "v", by="k", running=["w"]).count() == 0
    one = ordering.in_order(spark.createDataFrame([("a", 1, None)], "k string, v int, w double"), "v", running=["w"])
    row = one.withColumn("p", ordering.percent_rank(one)).first()
    assert (row["position"], row["rank"], row["n_rows"], row["p"], row["running_w"], row["total_w"]) == (1, 1, 1, 0.0, 0.0, None)


def test_rows_of_the_table_meet_in_no_single_task(spark):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("v"))
    plan = ordering.in_order(rows, "v")._jdf.queryExecution().executedPlan().toString()
    # the only window without a table key runs over one row per range
    assert plan.count("Exchange SinglePartition") <= 1 and "hashpartitioning(_range" in plan
    spread = ordering.in_order(rows, "v").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert spread < 40_000
