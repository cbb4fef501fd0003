"""Forecasts of many monthly series in one job.

Fits per series work on monthly rows: every operator first reduces its input to one
row per series and month, so a group handed to a Python worker is as long as the
calendar, whatever the size of the facts behind it.  The fits are small numpy solves
inside grouped tasks; Spark spreads the series."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from procurelytics.operators.features import event_flags
from procurelytics.operators.ranking import as_list, series_window

VALUE = "total_obligations_usd"


# --- frames -----------------------------------------------------------------------
def forecast_horizon(history: DataFrame, regressors, *, periods=12, series=None, order="month") -> DataFrame:
    """History plus the next ``periods`` months of each series, with the regressors of its
    last month carried forward.  The newest row of a series becomes its future rows, so
    the history is read once."""
    keys = as_list(series)
    newest = F.lead(order).over(series_window(series, order)).isNull()
    steps = F.when(F.col("_newest"), F.sequence(F.lit(0), F.lit(periods))).otherwise(F.array(F.lit(0)))
    rows = history.withColumn("_newest", newest).withColumn("_step", F.explode(steps))
    ahead = F.col("_step") > 0
    known = {c: F.when(~ahead, F.col(c)) for c in history.columns if c not in {*keys, order, *regressors}}
    return rows.withColumns({
        order: F.add_months(order, F.col("_step")), "is_forecast": ahead, **known,
    }).drop("_newest", "_step")


def carry_forward_regressors(frame: DataFrame, history: DataFrame, regressors, *, series=None, order="month") -> DataFrame:
    """The regressors of the same month where known, else the last known ones."""
    keys = as_list(series)
    joined = frame.join(history.select(*keys, order, *regressors), [*keys, order], "left")
    so_far = series_window(series, order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumns({r: F.last(r, ignorenulls=True).over(so_far) for r in regressors})


def forecast_union(*forecasts: DataFrame, run_id: str, as_of: Column, model_type: str | None = None) -> DataFrame:
    """Forecast tables of several models under one set of columns; a column that a model
    lacks is NULL."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), forecasts)
    marks = {
        "model_run_id": F.lit(run_id),
        "forecast_generated_at": F.current_timestamp(),
        "is_forecast": F.col("month") > as_of,
    }
    if model_type:
        marks["model_type"] = F.lit(model_type)
    return rows.withColumns(marks)


def forecast_metrics(preds: DataFrame, *, by=None, actual="actual_demand_usd", forecast="forecast_demand_usd",
                     lower="forecast_lower", upper="forecast_upper") -> DataFrame:
    """Absolute, squared and percentage error and the share of actuals inside the interval."""
    error = F.col(actual) - F.col(forecast)
    inside = (F.col(actual) >= F.col(lower)) & (F.col(actual) <= F.col(upper))
    return preds.groupBy(*as_list(by)).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(error, F.col(actual)))) * 100).alias("mape_pct"),
        F.avg(F.when(inside, 1.0).otherwise(0.0)).alias("coverage"),
    )


def monthly_series(df: DataFrame, y=VALUE, regressors=(), *, series=None, order="month") -> DataFrame:
    """One row per series and month: sum of the target, mean of the regressors.  Months
    without demand are left out of a fit."""
    key = F.lit("all") if series is None else F.col(series)
    reduced = df.groupBy(key.cast("string").alias("series"), F.trunc(order, "month").alias("month")).agg(
        F.sum(y).cast("double").alias("y"), *[F.avg(r).alias(r) for r in regressors],
    )
    return reduced.where(F.col("y") > 0)


def _spread(rows: DataFrame) -> DataFrame:
    """Series over all shuffle partitions.  Few bytes per series would let Spark merge the
    partitions into a handful of tasks, but the fits cost time, not bytes; an explicit
    number of partitions is left as it is.  The windows and the grouped fit that follow
    use this partitioning and shuffle no more."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "series")


def _z(level: float) -> float:
    return NormalDist().inv_cdf(0.5 + level / 2)


# --- trend and season by least squares -----------------------------------------------
def _waves(angle: Column, orders, cosine_only=()) -> list[Column]:
    return [f(angle * k) for k in orders for f in ((F.cos,) if k in cosine_only else (F.sin, F.cos))]


def design_rows(rows: DataFrame, regressors, *, yearly=6, quarterly=1, events=True) -> DataFrame:
    """Adds the design vector ``x``: 1, years since the series began, yearly and quarterly
    waves, calendar event flags, regressors; ``parts`` holds the sizes of these blocks.
    Monthly rows carry five yearly orders and the cosine of the sixth, whose sine is nil at
    month starts; together they fit any month of the year.  Of a 91.25-day season they carry
    only the first wave, which coincides with the fourth yearly order: where both are asked
    for, that order stands once, in the quarterly block.  Higher ones alias."""
    first = F.min("month").over(Window.partitionBy("series"))
    years = F.datediff("month", first) / 365.25
    days = F.datediff(F.col("month"), F.lit("1970-01-01").cast("date"))
    year, quarter = days * (2 * math.pi / 365.25), days * (2 * math.pi / 91.25)
    shared = [k for k in range(1, quarterly + 1) if 4 * k <= yearly]
    blocks = [
        [F.lit(1.0), years],
        _waves(year, [k for k in range(1, yearly + 1) if k not in [4 * q for q in shared]], cosine_only=(6,)),
        _waves(year * 4, shared) + _waves(quarter, [k for k in range(1, quarterly + 1) if k not in shared]),
        [c.cast("double") for c in event_flags(F.col("month")).values()] if events else [],
        [F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in regressors],
    ]
    return rows.withColumns({
        "x": F.array(*[c for block in blocks for c in block]),
        "parts": F.array(*[F.lit(len(block)) for block in blocks]),
    })


class _Ridge:
    """Least squares on the log of demand with a small penalty on all but the level; the
    log makes trend, season and regressors multiply."""

    def __init__(self, x, y, penalty):
        self.mean = x.mean(axis=0)
        self.mean[0] = 0.0
        self.scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
        z = (x - self.mean) / self.scale
        weight = np.full(x.shape[1], float(penalty))
        weight[0] = 0.0
        target = np.log1p(y)
        self.coef = np.linalg.lstsq(z.T @ z + np.diag(weight + 1e-9), z.T @ target, rcond=None)[0]
        spare = max(len(y) - x.shape[1], 1)
        self.sd = math.sqrt(float(((target - z @ self.coef) ** 2).sum()) / spare)

    def terms(self, x):
        return (x - self.mean) / self.scale * self.coef

    def predict(self, x):
        return self.terms(x).sum(axis=1)


FOURIER_SCHEMA = (
    "series string, month date, forecast_demand_usd double, forecast_lower double, forecast_upper double, trend double, "
    "yearly_seasonality double, fiscal_quarterly_seasonality double, actual_demand_usd double, is_forecast boolean, model_type string"
)


def forecast_fourier(df: DataFrame, *, series=None, y=VALUE, regressors=(), horizon=12, level=0.95, yearly=6, quarterly=1,
                     events=True, penalty=1.0) -> DataFrame:
    """Trend, yearly and quarterly season, calendar events and regressors per series;
    fitted months and the next ``horizon`` ones, with an interval from the residuals."""
    rows = forecast_horizon(_spread(monthly_series(df, y, regressors, series=series)), list(regressors), periods=horizon, series="series")
    design = design_rows(rows, regressors, yearly=yearly, quarterly=quarterly, events=events)
    z = _z(level)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month")
        x = np.stack(pdf["x"].to_numpy())
        known = ~pdf["is_forecast"].to_numpy(bool)
        model = _Ridge(x[known], pdf["y"].to_numpy(float)[known], penalty)
        terms, hat = model.terms(x), model.predict(x)
        cut = np.cumsum(pdf["parts"].iloc[0])
        return pd.DataFrame({
            "series": pdf["series"], "month": pdf["month"],
            "forecast_demand_usd": np.expm1(hat),
            "forecast_lower": np.expm1(hat - z * model.sd), "forecast_upper": np.expm1(hat + z * model.sd),
            "trend": np.expm1(terms[:, : cut[0]].sum(axis=1)),
            "yearly_seasonality": np.expm1(terms[:, cut[0]: cut[1]].sum(axis=1)),
            "fiscal_quarterly_seasonality": np.expm1(terms[:, cut[1]: cut[2]].sum(axis=1)),
            "actual_demand_usd": pdf["y"], "is_forecast": pdf["is_forecast"], "model_type": "FOURIER",
        })

    return design.select("series", "month", "y", "x", "parts", "is_forecast").groupBy("series").applyInPandas(fit, FOURIER_SCHEMA)


CV_SCHEMA = (
    "series string, cutoff date, month date, actual_demand_usd double, forecast_demand_usd double, forecast_lower double, forecast_upper double"
)


def forecast_cv(df: DataFrame, *, series=None, y=VALUE, regressors=(), initial=730, period=90, horizon=90, level=0.95,
                yearly=6, quarterly=1, events=True, penalty=1.0) -> DataFrame:
    """Rolling-origin check of the same model: cutoffs every ``period`` days back from the
    end, each with at least ``initial`` days before it and ``horizon`` days after it.
    No row after a cutoff enters its fit."""
    design = design_rows(_spread(monthly_series(df, y, regressors, series=series)), regressors, yearly=yearly, quarterly=quarterly, events=events)
    z = _z(level)

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month")
        months = pd.to_datetime(pdf["month"])
        x, target = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy(float)
        cutoff, out = months.iloc[-1] - pd.Timedelta(days=horizon), []
        while cutoff >= months.iloc[0] + pd.Timedelta(days=initial):
            seen = (months <= cutoff).to_numpy()
            ahead = ((months > cutoff) & (months <= cutoff + pd.Timedelta(days=horizon))).to_numpy()
            if ahead.any() and seen.sum() > 2:
                model = _Ridge(x[seen], target[seen], penalty)
                hat = model.predict(x[ahead])
                out.append(pd.DataFrame({
                    "series": pdf["series"].iloc[0], "cutoff": cutoff.date(), "month": pdf["month"].to_numpy()[ahead],
                    "actual_demand_usd": target[ahead], "forecast_demand_usd": np.expm1(hat),
                    "forecast_lower": np.expm1(hat - z * model.sd), "forecast_upper": np.expm1(hat + z * model.sd),
                }))
            cutoff -= pd.Timedelta(days=period)
        columns = [part.split()[0] for part in CV_SCHEMA.split(", ")]
        return pd.concat(out) if out else pd.DataFrame(columns=columns)

    return design.select("series", "month", "y", "x").groupBy("series").applyInPandas(check, CV_SCHEMA)


# --- seasonal autoregression -----------------------------------------------------------
AR_SCHEMA = (
    "series string, month date, forecast_demand_usd double, forecast_lower double, forecast_upper double, "
    "actual_demand_usd double, is_forecast boolean, ar_order int, seasonal boolean, model_type string"
)


def _ar_fit(z, exog, p, first, known):
    """AR(p) with exogenous terms on the known months from ``first`` on, so that all orders are
    compared on the same months.  A small penalty on all but the level lets short histories carry
    every exogenous term."""
    at = np.flatnonzero(known & (np.arange(len(z)) >= first))
    x = np.column_stack([np.ones(len(z)), *[np.concatenate([np.zeros(k), z[: len(z) - k]]) for k in range(1, p + 1)], exog])
    scale = np.where(x[at].std(axis=0) > 1e-9, x[at].std(axis=0), 1.0)
    penalty = np.diag(np.r_[0.0, np.full(x.shape[1] - 1, 1e-2)] + 1e-9)
    w = x[at] / scale
    coef = np.linalg.solve(w.T @ w + penalty, w.T @ z[at]) / scale
    rss = float(((z[at] - x[at] @ coef) ** 2).sum())
    n = len(at)
    aic = n * math.log(max(rss / n, 1e-12)) + 2 * (x.shape[1] + 1)
    return aic, coef, math.sqrt(rss / max(n - x.shape[1], 1)), x @ coef


def _ar_spread(coef, p, steps, season):
    """Growth of the forecast deviation by step, from the model's moving-average weights."""
    psi = np.zeros(steps)
    for h in range(steps):
        psi[h] = (1.0 if h == 0 else 0.0) + sum(coef[1 + k] * psi[h - 1 - k] for k in range(p) if h - 1 - k >= 0)
    if season:
        for h in range(season, steps):
            psi[h] += psi[h - season]
    return np.sqrt(np.cumsum(psi ** 2))


def forecast_ar(df: DataFrame, *, series=None, y=VALUE, exog=(), max_p=3, season=12, horizon=12, level=0.95) -> DataFrame:
    """Autoregression of the yearly difference with exogenous terms, order 0 to ``max_p``
    by AIC; no moving-average terms.  Differences and lags go by month: a month without demand is a
    gap, which no fit uses as a target and lags read as the year before plus the mean growth.  A
    series without a year of yearly differences is fitted undifferenced (``seasonal`` says so).
    Every month of the history has a row, with a NULL forecast where its lags begin before the
    series; fitted months and the next ``horizon`` months carry an interval."""
    rows = forecast_horizon(_spread(monthly_series(df, y, exog, series=series)), list(exog), periods=horizon, series="series")
    zq, exog = _z(level), list(exog)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month").reset_index(drop=True)
        months = pd.to_datetime(pdf["month"])
        t = (months.dt.year * 12 + months.dt.month).to_numpy()
        t, past = t - t[0], ~pdf["is_forecast"].to_numpy(bool)
        n, end = t[past][-1] + 1, t[-1] + 1
        target, e = np.full(n, np.nan), np.zeros((end, len(exog)))
        target[t[past]] = np.log1p(pdf["y"].to_numpy(float)[past])
        given = np.zeros(end, bool)
        if exog:
            e[t] = pdf[exog].fillna(0.0).to_numpy(float)
            given[t] = True
        seen = np.isfinite(target)
        yearly = target[season:] - target[:-season] if n > season else np.empty(0)
        lag = season if np.isfinite(yearly).sum() >= season else 0
        whole, growth = target.copy(), float(np.nanmean(yearly)) if lag else 0.0
        for i in np.flatnonzero(~seen):
            whole[i] = whole[i - lag] + growth if lag and i >= lag else np.interp(i, np.flatnonzero(seen), target[seen])
        z = whole[lag:] - whole[: n - lag] if lag else whole
        ez = np.where((given[lag:] & given[: end - lag])[:, None], e[lag:] - e[: end - lag], 0.0) if lag else e
        known = seen[lag:] & seen[: n - lag] if lag else seen
        top = min(max_p, max(int(known.sum()) // 4, 0))
        while top and not (known & (np.arange(len(z)) >= top)).sum() > 2 * top + 2:
            top -= 1
        best = min(((*_ar_fit(z, ez[: len(z)], p, top, known), p) for p in range(top + 1)), key=lambda c: c[0])
        _, coef, sd, fitted, p = best
        path, levels = list(z), list(whole)
        for h in range(end - n):
            value = coef[0] + sum(coef[1 + k] * path[-1 - k] for k in range(p)) + float(ez[len(z) + h] @ coef[1 + p:])
            path.append(value)
            levels.append(value + (levels[n + h - lag] if lag else 0.0))
        hat = np.concatenate([np.full(lag + top, np.nan), fitted[top:] + (whole[top : n - lag] if lag else 0.0), levels[n:]])
        spread = np.concatenate([np.full(n, sd), sd * _ar_spread(coef, p, end - n, lag)])
        hat, spread = hat[t], spread[t]
        return pd.DataFrame({
            "series": pdf["series"], "month": pdf["month"], "forecast_demand_usd": np.expm1(hat),
            "forecast_lower": np.expm1(hat - zq * spread), "forecast_upper": np.expm1(hat + zq * spread),
            "actual_demand_usd": pdf["y"], "is_forecast": pdf["is_forecast"], "ar_order": p, "seasonal": bool(lag), "model_type": "SEASONAL_AR",
        })

    return rows.groupBy("series").applyInPandas(fit, AR_SCHEMA)
