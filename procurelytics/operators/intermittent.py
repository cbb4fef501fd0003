"""Intermittent-demand forecasts, the methods the inventory table recommends by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from procurelytics.operators.forecast import VALUE
from procurelytics.operators.ranking import as_list


def croston_sba(df: DataFrame, *, series, value=VALUE, order="month", alpha=0.1) -> DataFrame:
    """Croston's demand rate per series and its SBA correction.  Demand sizes and the gaps
    between them are smoothed separately, in time order; months without demand count
    through the gap.  The list folded over is one entry per month."""
    keys = as_list(series)
    monthly = df.groupBy(*keys, F.trunc(order, "month").alias("m")).agg(F.sum(value).cast("double").alias("y")).where(F.col("y") > 0)
    index = F.months_between("m", F.lit("1970-01-01").cast("date")).cast("int")
    lists = monthly.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(index.alias("t"), F.col("y")))).alias("points"))
    start = F.struct(F.lit(None).cast("double").alias("size"), F.lit(None).cast("double").alias("gap"), F.lit(None).cast("int").alias("t"))

    def step(state, point):
        gap = (point["t"] - state["t"]).cast("double")
        return F.struct(
            F.coalesce(state["size"] + alpha * (point["y"] - state["size"]), point["y"]).alias("size"),
            F.coalesce(state["gap"] + alpha * (gap - state["gap"]), gap).alias("gap"),
            point["t"].alias("t"),
        )

    folded = lists.withColumn("s", F.aggregate("points", start, step))
    rate = F.col("s.size") / F.coalesce(F.col("s.gap"), F.lit(1.0))
    return folded.select(
        *keys, F.size("points").alias("demand_months"), F.col("s.size").alias("demand_size"),
        F.coalesce(F.col("s.gap"), F.lit(1.0)).alias("demand_interval"),
        rate.alias("croston_forecast"), (rate * (1 - alpha / 2)).alias("sba_forecast"),
    )
