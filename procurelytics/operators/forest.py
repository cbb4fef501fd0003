"""Random forest forecasts, pooled over all series, on Spark's own learner."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from procurelytics.operators import trees
from procurelytics.operators.features import TARGET, demand_features, feature_columns, temporal_split
from procurelytics.operators.ranking import as_list, series_window
from procurelytics.session import cut_lineage
from procurelytics.sources.tables import literal_rows

VECTOR = "features"


def prepare(df: DataFrame, *, target=TARGET, series=None, test=12, parity=False) -> tuple[DataFrame, list[str]]:
    """Feature rows with a TRAIN / TEST mark, written once because the learner passes
    over them many times, and the names of the features."""
    rows = demand_features(df, target=target, series=series, parity=parity)
    names = feature_columns(rows, series=series)
    return cut_lineage(temporal_split(rows, series=series, test=test)), names


def assemble(df: DataFrame, names) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=VECTOR).transform(df)


def fit_rf(train: DataFrame, names, *, target=TARGET, trees=200, depth=15, min_rows=3, seed=42) -> RandomForestRegressionModel:
    """``min_rows`` per leaf stands in for a minimum of five rows per split."""
    learner = RandomForestRegressor(
        featuresCol=VECTOR, labelCol=target, predictionCol="forecast_demand_usd", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_rows, seed=seed, maxMemoryInMB=512,
    )
    return learner.fit(assemble(train, names))


def rf_predict(model: RandomForestRegressionModel, df: DataFrame, names) -> DataFrame:
    return model.transform(assemble(df, names)).drop(VECTOR)


def rf_importance(spark: SparkSession, model: RandomForestRegressionModel, names) -> DataFrame:
    """Impurity importance per feature, ranked: model numbers, as long as the feature list."""
    pairs = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    pairs.sort(key=lambda p: (-p[1], p[0]))
    rows = [(n, v, "RandomForest", i + 1) for i, (n, v) in enumerate(pairs)]
    return literal_rows(spark, rows, ["feature", "importance", "model_type", "rank"])


def rf_intervals(model: RandomForestRegressionModel, df: DataFrame, names, *, level=0.95) -> DataFrame:
    """Forecast with the lower and upper percentile of the single trees' predictions: all trees are walked
    in one pass over the row, nothing is shuffled."""
    return trees.with_intervals(df, trees.flatten(df.sparkSession, model), names, level=level).withColumn("tree_mean", F.col("forecast_demand_usd"))


def rf_shap(model: RandomForestRegressionModel, df: DataFrame, names) -> DataFrame:
    """Rows with their forecast, base value and Shapley values per feature."""
    flat = trees.flatten(df.sparkSession, model)
    return trees.shap_values(trees.with_intervals(df, flat, names), flat, names)


def permutation_importance(model: RandomForestRegressionModel, df: DataFrame, names, *, series=None, target=TARGET, seed=7) -> DataFrame:
    """Growth of the squared-error root when one feature is taken from another month of the
    same series (the next in a hashed order, the last one wraps around)."""
    names = list(names)
    ring = series_window(series, F.xxhash64(F.lit(seed), F.col("month")), "month")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    actual = F.array(*[F.col(n).cast("double") for n in names])
    rows = df.withColumn("_x", actual)
    other = F.coalesce(F.lead("_x").over(ring), F.first("_x").over(whole))
    swaps = F.array(F.lit(-1), *[F.lit(i) for i in range(len(names))])
    one = rows.withColumn("_other", other).select(F.col(target).alias("y"), "_x", "_other", F.explode(swaps).alias("j"))
    mixed = F.transform("_x", lambda v, i: F.when(i == F.col("j"), F.get("_other", i)).otherwise(v))
    scored = model.transform(one.select("y", "j", array_to_vector(mixed).alias(VECTOR)))
    error = F.col("forecast_demand_usd") - F.col("y")
    rmse = scored.groupBy("j").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    # one row per feature: the base error meets them without a join
    base = F.max(F.when(F.col("j") == -1, F.col("rmse"))).over(Window.partitionBy(F.lit(0)))
    named = rmse.withColumn("base_rmse", base).where(F.col("j") >= 0)
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1)
    return named.select(feature.alias("feature"), (F.col("rmse") - F.col("base_rmse")).alias("rmse_increase"), "base_rmse")


# --- recursive forecast -------------------------------------------------------------------
def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def _step_features(ys: np.ndarray, month: pd.Series, start: pd.Series, carried: dict) -> dict:
    """The features of ``month`` from the twelve values before it (oldest first); a row per series."""
    out = {f"demand_lag_{k}m": ys[:, -k] for k in (1, 3, 6, 12)}
    for k in (3, 6, 12):
        last = ys[:, -k:]
        out |= {f"demand_rolling_mean_{k}m": last.mean(axis=1), f"demand_rolling_std_{k}m": last.std(axis=1, ddof=1),
                f"demand_rolling_min_{k}m": last.min(axis=1), f"demand_rolling_max_{k}m": last.max(axis=1)}
    out["demand_trend_3m"], out["demand_trend_6m"] = ys[:, -1] - ys[:, -3], ys[:, -1] - ys[:, -6]
    out["months_since_start"] = (month - start).dt.days.to_numpy() / 30.44
    number = month.dt.month.to_numpy()
    quarter = (number - 1) // 3 + 1
    out |= {"month_of_year": number, "quarter": quarter, "is_q4": quarter == 4, "month_sin": np.sin(2 * np.pi * number / 12), "month_cos": np.cos(2 * np.pi * number / 12)}
    if {"geo_risk_index", "tariff_risk_index"} <= set(carried):
        out["combined_risk_interaction"] = carried["geo_risk_index"] * carried["tariff_risk_index"]
        out["geo_risk_lag_1m"], out["tariff_risk_lag_1m"] = carried["geo_risk_index"], carried["tariff_risk_index"]
    if "commodity_cost_pressure" in carried:
        out["commodity_lag_1m"], out["commodity_trend_3m"] = carried["commodity_cost_pressure"], np.zeros(len(ys))
    if "weather_disruption_index" in carried:
        out["weather_lag_1m"] = carried["weather_disruption_index"]
    return out


def forecast_rf_recursive(model: RandomForestRegressionModel, history: DataFrame, names, *, series=None, target=TARGET,
                          months=12, margin=0.15) -> DataFrame:
    """The next ``months`` months, each predicted from the values before it, predicted ones
    included, with the features of the month itself.  A series is one row holding its
    last twelve values; all steps of many series run in one pass over the flattened trees, so no step is
    stored.  A series of less than twelve months is led by its mean.  Other columns stay
    at their last value; the interval is plus and minus ``margin``."""
    keys = as_list(series)
    made = {"month_of_year", "quarter", "is_q4", "month_sin", "month_cos"}
    carried = [c for c in names if c in history.columns and c not in made]
    age = F.row_number().over(series_window(series, F.col("month").desc()))
    start = F.min("month").over(Window.partitionBy(*(keys or [F.lit(0)])))
    recent = history.withColumns({"_age": age, "_start": start}).where(F.col("_age") <= 12)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("month", F.col(target).cast("double").alias("y")))), lambda r: r["y"])
    state = recent.groupBy(*keys).agg(
        F.max("month").alias("_last"), F.min("_start").alias("_start"), ordered.alias("_ys"),
        *[F.max_by(c, "month").alias(c) for c in carried],
    ).withColumn("_ys", F.concat(F.array_repeat(_mean(F.col("_ys")), 12 - F.size("_ys")), F.col("_ys")))
    flat = trees.flatten(history.sparkSession, model)

    @F.pandas_udf("array<double>")
    def ahead(ys: pd.Series, last: pd.Series, start: pd.Series, held: pd.Series) -> pd.Series:
        path, last, start = np.array([np.asarray(v, float) for v in ys]).reshape(len(ys), 12), pd.to_datetime(last), pd.to_datetime(start)
        kept = dict(zip(carried, np.array([np.asarray(v, float) for v in held]).reshape(len(ys), len(carried)).T))
        for step in range(1, months + 1):
            made_now = _step_features(path[:, -12:], last + pd.DateOffset(months=step), start, kept)
            x = np.column_stack([made_now.get(n, kept.get(n)) for n in names])
            path = np.column_stack([path, flat.votes(x.astype(float)).mean(axis=1)])
        return pd.Series(list(path[:, 12:]))

    values = ahead("_ys", "_last", "_start", F.array(*[F.col(c).cast("double") for c in carried]).cast("array<double>"))
    state = state.withColumn("_values", values).select(*keys, F.transform("_values", lambda y, i: F.struct(F.add_months("_last", i + 1).alias("month"), y.alias("y"))).alias("_out"))
    value = F.col("o.y")
    return state.select(*keys, F.explode("_out").alias("o")).select(
        *keys, F.col("o.month").alias("month"), value.alias("forecast_demand_usd"),
        (value * (1 - margin)).alias("forecast_lower"), (value * (1 + margin)).alias("forecast_upper"),
        F.lit(None).cast("double").alias("actual_demand_usd"), F.lit(False).alias("is_actual"), F.lit("RANDOM_FOREST").alias("model_type"),
    )
