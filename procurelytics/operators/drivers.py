"""Feature importance reports: rank, label, category, cumulative share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import ladder, lookup
from procurelytics.operators.ranking import series_window


def feature_label(feature: Column) -> Column:
    """Known label, else the name in title case."""
    return F.coalesce(lookup(feature, K.FEATURE_LABELS), F.initcap(F.translate(feature, "_", " ")))


def feature_category(feature: Column) -> Column:
    cases = []
    for category, prefixes in K.FEATURE_CATEGORIES.items():
        hit = F.lit(False)
        for prefix in prefixes:
            hit = hit | feature.startswith(prefix)
        cases.append((hit, category))
    return ladder(cases, "Other")


def feature_categories(fi: DataFrame) -> DataFrame:
    name = F.col("feature")
    return fi.withColumns({"label": feature_label(name), "category": feature_category(name)})


def importance_rank(fi: DataFrame) -> DataFrame:
    """Rank by importance; equal importance by name.  One row per feature, so the
    ranked set has the width of the feature table, not the length of the data."""
    order = series_window(None, F.col("importance").desc(), "feature")
    return fi.withColumn("rank", F.row_number().over(order))


def importance_pareto(fi: DataFrame, *, top_n=20, cutoff=80) -> DataFrame:
    """The top features with label, category, running share, the share of each category
    and the number of features that reach ``cutoff`` percent."""
    top = feature_categories(importance_rank(fi)).where(F.col("rank") <= top_n)
    everything = series_window(None, F.col("rank"))
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("importance").over(whole)
    running = F.sum("importance").over(everything.rowsBetween(Window.unboundedPreceding, 0))
    by_category = series_window("category", F.col("rank")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shares = top.withColumns({
        "cumulative_pct": running / total * 100,
        "category_pct": F.sum("importance").over(by_category) / total * 100,
    })
    reached = F.sum(F.when(F.col("cumulative_pct") <= cutoff, 1).otherwise(0)).over(whole) + 1
    return shares.withColumn("features_to_cutoff", reached)


def demand_drivers(fi: DataFrame, *, top_n=10) -> DataFrame:
    """The top features and, on every row, the family of the first one."""
    top = feature_categories(importance_rank(fi)).where(F.col("rank") <= top_n)
    leader = F.first("feature").over(series_window(None, F.col("rank")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cases = []
    for parts, insight in K.DRIVER_FAMILIES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.col("_leader").contains(part)
        cases.append((hit, insight))
    return top.withColumn("_leader", leader).withColumn("insight", ladder(cases, "Mixed drivers")).drop("_leader")
