"""Dense monthly series: one row per month, so that row frames and lags are month frames and lags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from procurelytics.operators.ranking import as_list


def series_spine(df: DataFrame, *, series=None, month="month", zero=()) -> DataFrame:
    """Every month from the first to the last of each series, with 0 in the columns ``zero`` and NULL
    in the others where a series has no row.  ``df`` has at most one row per series and month.  Each
    row brings the empty months that follow it: one window per series over monthly rows, no join."""
    keys, values = as_list(series), [c for c in df.columns if c not in {*as_list(series), month}]
    following = F.lead(month).over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(month))
    rows = df.withColumn("_until", F.coalesce(F.add_months(following, -1), F.col(month)))
    rows = rows.withColumn("_month", F.explode(F.sequence(F.col(month), F.col("_until"), F.expr("interval 1 month"))))
    own = F.col("_month") == F.col(month)
    filled = [F.when(own, F.col(c)).otherwise(F.lit(0) if c in zero else F.lit(None)).alias(c) for c in values]
    return rows.select(*keys, F.col("_month").alias(month), *filled)
