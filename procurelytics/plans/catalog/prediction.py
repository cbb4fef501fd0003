"""Features, horizon frames, forecast tables and their metrics."""

from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions import dates
from procurelytics.operators import arima, changepoints, features, forecast, forest, intermittent, rollups, trees
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import cte, query, shown, sql

Y = "total_obligations_usd"


def lag(k, column=Y):
    return f"lag({column}, {k}) OVER (PARTITION BY series ORDER BY month)"


LAGS = {f"demand_lag_{k}m": lag(k) for k in (1, 3, 6, 12)}
ROLLS = {
    f"demand_rolling_{name}_{k}m": f"CASE WHEN count({Y}) OVER r{k} = {k} THEN {f}({Y}) OVER r{k} END"
    for k in (3, 6, 12) for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
}
TRENDS = {
    "demand_trend_3m": f"{lag(1)} - {lag(3)}", "demand_trend_6m": f"{lag(1)} - {lag(6)}",
    "demand_pct_change_1m": f"({Y} - {lag(1)}) / {lag(1)}", "demand_pct_change_3m": f"({Y} - {lag(3)}) / {lag(3)}",
}
SEASONS = {
    "month_of_year": "month(month)", "quarter": "quarter(month)", "is_q4": "CASE WHEN quarter(month) = 4 THEN 1 ELSE 0 END",
    "month_sin": "sin(2 * pi() * month(month) / 12)", "month_cos": "cos(2 * pi() * month(month) / 12)",
}
RISKY = {
    "combined_risk_interaction": "geo_risk_index * tariff_risk_index", "geo_risk_lag_1m": lag(1, "geo_risk_index"),
    "tariff_risk_lag_1m": lag(1, "tariff_risk_index"),
    "months_since_start": "date_diff('day', min(month) OVER (PARTITION BY series), month) / 30.44",
}
WINDOWS = "WINDOW " + ", ".join(f"r{k} AS (PARTITION BY series ORDER BY month ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in (3, 6, 12))
EVERY = {**LAGS, **ROLLS, **TRENDS, **SEASONS, **RISKY}
cte("features", "type_demand", f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in EVERY.items())} FROM type_demand {WINDOWS}")


def feature_query(columns):
    return f"SELECT series, month, {', '.join(columns)} FROM features"


@query("lag_features", sql("features", feature_query(LAGS), doubles=" ".join(LAGS)))
def lag_features(spark, d):
    return shown(features.lag_features(B.type_demand(spark, d), series="series"), "series", "month", *LAGS)


@query("rolling_features", sql("features", feature_query(ROLLS), doubles=" ".join(ROLLS), digits=2))
def rolling_features(spark, d):
    return shown(features.rolling_features(B.type_demand(spark, d), series="series"), "series", "month", *ROLLS, digits=2)


@query("trend_features", sql("features", feature_query(TRENDS), doubles=" ".join(TRENDS)))
def trend_features(spark, d):
    return shown(features.trend_features(B.type_demand(spark, d), series="series"), "series", "month", *TRENDS)


KEPT = [c for c in EVERY if "pct_change" not in c]
WHOLE = "month_of_year quarter is_q4"


@query("demand_features", sql("features", feature_query(KEPT) + " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in KEPT),
                              ints=WHOLE, doubles=" ".join(c for c in KEPT if c not in WHOLE.split()), digits=2))
def demand_features(spark, d):
    return shown(features.demand_features(B.type_demand(spark, d), series="series"), "series", "month", *KEPT, digits=2)


@query("temporal_split", sql("type_demand", f"""
SELECT series, split, count(*) AS n_rows, min(month) AS first_month, max(month) AS last_month, sum({Y}) AS demand FROM (
SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY month DESC) <= 12 THEN 'TEST' ELSE 'TRAIN' END AS split FROM type_demand)
GROUP BY 1, 2""", ints="n_rows", doubles="demand", digits=2))
def temporal_split(spark, d):
    rows = features.temporal_split(B.type_demand(spark, d), series="series")
    return shown(rows.groupBy("series", "split").agg(
        F.count("*").alias("n_rows"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.sum(Y).alias("demand")), digits=2)


OVERLAP = ", ".join(
    f"""CASE WHEN {' OR '.join(f"(make_date(year(month) + ({s}), {m}, {day}) - {before} <= last_day(month) AND make_date(year(month) + ({s}), {m}, {day}) + {after} >= month)" for s in (-1, 0, 1))} THEN 1 ELSE 0 END AS {name}"""
    for name, m, day, before, after in K.CALENDAR_EVENTS)
EVENT_NAMES = [e[0] for e in K.CALENDAR_EVENTS]


@query("calendar_events", sql("prime_m", f"SELECT month, prime_action_count, {OVERLAP} FROM prime_m", ints=" ".join(["prime_action_count", *EVENT_NAMES])))
def calendar_events(spark, d):
    rows = rollups.prime_monthly(B.award_actions(spark, d))
    return shown(rows.select("month", "prime_action_count", *[c.alias(n) for n, c in features.event_flags(F.col("month")).items()]))


# --- horizon --------------------------------------------------------------------------
cte("horizon", "type_demand", """
SELECT series, CAST(last_month + to_months(CAST(h AS INTEGER)) AS DATE) AS month, geo_risk_index, tariff_risk_index FROM (
SELECT series, max(month) AS last_month, arg_max(geo_risk_index, month) AS geo_risk_index, arg_max(tariff_risk_index, month) AS tariff_risk_index
FROM type_demand GROUP BY 1) CROSS JOIN range(1, 13) r(h)""")


@query("forecast_horizon", sql("horizon", """
SELECT series, month, geo_risk_index, tariff_risk_index, true AS is_forecast FROM horizon
UNION ALL SELECT series, month, geo_risk_index, tariff_risk_index, false FROM type_demand""", doubles="geo_risk_index tariff_risk_index"))
def forecast_horizon(spark, d):
    out = forecast.forecast_horizon(B.type_demand(spark, d), ["geo_risk_index", "tariff_risk_index"], series="series")
    return shown(out, "series", "month", "geo_risk_index", "tariff_risk_index", "is_forecast")


@query("carry_forward_regressors", sql("type_demand", """
SELECT series, month, last_value(geo_risk_index IGNORE NULLS) OVER (PARTITION BY series ORDER BY month ROWS UNBOUNDED PRECEDING) AS geo_risk_index FROM (
SELECT g.series, g.month, t.geo_risk_index FROM (
  SELECT series, CAST(unnest(generate_series(min(month), max(month) + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM type_demand GROUP BY 1) g
LEFT JOIN (SELECT * FROM type_demand WHERE quarter(month) <> 3) t ON t.series = g.series AND t.month = g.month)""", doubles="geo_risk_index"))
def carry_forward_regressors(spark, d):
    history = B.type_demand(spark, d)
    span = history.groupBy("series").agg(F.min("month").alias("a"), F.add_months(F.max("month"), 6).alias("b"))
    frame = span.select("series", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    known = history.where(F.quarter("month") != 3)
    return shown(forecast.carry_forward_regressors(frame, known, ["geo_risk_index"], series="series"))


# --- forecast tables ---------------------------------------------------------------------
@query("forecast_union", sql("forecasts", """
SELECT month, forecast_demand_usd, CASE WHEN model <> 'random_forest' THEN forecast_lower END AS forecast_lower, model_type, 'run-1' AS model_run_id,
       month > DATE '2001-08-01' AS is_forecast FROM forecasts""", doubles="forecast_demand_usd forecast_lower", digits=2))
def forecast_union(spark, d):
    tables = B.forecasts(B.stored_signals(spark, d))
    tables["random_forest"] = tables["random_forest"].drop("forecast_lower")
    out = forecast.forecast_union(*tables.values(), run_id="run-1", as_of=B.as_of())
    return shown(out, "month", "forecast_demand_usd", "forecast_lower", "model_type", "model_run_id", "is_forecast", digits=2)


@query("forecast_metrics", sql("forecasts signals", """
SELECT model_type, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, avg(abs(e / y)) * 100 AS mape_pct,
       avg(CASE WHEN y BETWEEN forecast_lower AND forecast_upper THEN 1.0 ELSE 0.0 END) AS coverage FROM (
SELECT f.*, total_obligations_usd AS y, total_obligations_usd - forecast_demand_usd AS e FROM forecasts f JOIN signals s ON s.month = f.month WHERE total_obligations_usd > 0)
GROUP BY 1""", ints="n", doubles="mae rmse mape_pct coverage", digits=2))
def forecast_metrics(spark, d):
    signals = B.stored_signals(spark, d)
    actual = signals.select("month", F.col(Y).alias("actual_demand_usd")).where(F.col("actual_demand_usd") > 0)
    frames = [f.join(actual, "month") for f in B.forecasts(signals).values()]
    return shown(forecast.forecast_metrics(frames[0].unionByName(frames[1]).unionByName(frames[2]), by="model_type"), digits=2)


# --- fits: no SQL says the same, tests check them on planted series --------------------------
EXOG = ["geo_risk_index", "tariff_risk_index"]


@query("forecast_fourier")
def forecast_fourier(spark, d):
    return shown(forecast.forecast_fourier(B.type_demand(spark, d), series="series", regressors=EXOG))


@query("forecast_cv")
def forecast_cv(spark, d):
    checks = forecast.forecast_cv(B.type_demand(spark, d), series="series", regressors=EXOG)
    return shown(forecast.forecast_metrics(checks, by="series"))


@query("forecast_ar")
def forecast_ar(spark, d):
    return shown(forecast.forecast_ar(B.vendor_demand(spark, d), series="series"))


@query("forecast_arima")
def forecast_arima(spark, d):
    return shown(arima.forecast_arima(B.type_demand(spark, d), series="series", exog=EXOG))


@query("forecast_changepoints")
def forecast_changepoints(spark, d):
    return shown(changepoints.forecast_changepoints(B.vendor_demand(spark, d), series="series"))


def _forest(spark, d):
    rows, names = forest.prepare(B.type_demand(spark, d), series="series")
    return rows, names, forest.fit_rf(rows.where(F.col("split") == "TRAIN"), names)


@query("forecast_rf")
def forecast_rf(spark, d):
    rows, names, model = _forest(spark, d)
    out = forest.rf_predict(model, rows.where(F.col("split") == "TEST"), names)
    return shown(out, "series", "month", F.col(Y).alias("actual_demand_usd"), "forecast_demand_usd")


@query("forecast_rf_recursive")
def forecast_rf_recursive(spark, d):
    rows, names, model = _forest(spark, d)
    return shown(forest.forecast_rf_recursive(model, B.type_demand(spark, d), names, series="series"))


@query("rf_intervals")
def rf_intervals(spark, d):
    rows, names, model = _forest(spark, d)
    out = forest.rf_intervals(model, rows.where(F.col("split") == "TEST"), names)
    return shown(out, "series", "month", F.col(Y).alias("actual_demand_usd"), "forecast_demand_usd", "forecast_lower", "forecast_upper", "tree_mean")


@query("rf_importance")
def rf_importance(spark, d):
    _, names, model = _forest(spark, d)
    return shown(forest.rf_importance(spark, model, names))


@query("shap_importance")
def shap_importance(spark, d):
    rows, names, model = _forest(spark, d)
    explained = forest.rf_shap(model, rows.where(F.col("split") == "TEST"), names)
    return shown(trees.shap_importance(explained, names))


@query("shap_values")
def shap_values(spark, d):
    rows, names, model = _forest(spark, d)
    explained = forest.rf_shap(model, rows.where(F.col("split") == "TEST"), names)
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("shap").alias("value"))
    return shown(explained.select("series", "month", "forecast_demand_usd", "base_value", F.inline(named)))


@query("permutation_importance")
def permutation_importance(spark, d):
    rows, names, model = _forest(spark, d)
    return shown(forest.permutation_importance(model, rows.where(F.col("split") == "TEST"), names, series="series"))


@query("croston_sba")
def croston_sba(spark, d):
    return shown(intermittent.croston_sba(B.vendor_demand(spark, d), series="series"))
