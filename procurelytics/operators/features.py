"""Forecast features for many monthly series in one job.

Every window is keyed by the series, and a series has one row per month, so no
window partition grows with the fact tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from procurelytics import constants as K
from procurelytics.operators.ranking import as_list, series_window
from procurelytics.sources.tables import literal_rows

TARGET = "total_obligations_usd"
TARGET_PARTS = ["month", TARGET, "prime_obligations_usd", "subaward_obligations_usd"]


def lag_columns(target=TARGET, order="month", series=None, lags=(1, 3, 6, 12)) -> dict:
    window = series_window(series, order)
    return {f"demand_lag_{k}m": F.lag(target, k).over(window) for k in lags}


def rolling_columns(target=TARGET, order="month", series=None, windows=(3, 6, 12)) -> dict:
    """Mean, sample deviation, min and max of the k rows before the current one; NULL
    until all k are there."""
    out = {}
    for k in windows:
        frame = series_window(series, order).rowsBetween(-k, -1)
        full = F.count(target).over(frame) == k
        for name, stat in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            out[f"demand_rolling_{name}_{k}m"] = F.when(full, stat(target).over(frame))
    return out


def trend_columns(target=TARGET, order="month", series=None) -> dict:
    window = series_window(series, order)
    lag = {k: F.lag(target, k).over(window) for k in (1, 3, 6)}
    now = F.col(target)
    return {
        "demand_trend_3m": lag[1] - lag[3],
        "demand_trend_6m": lag[1] - lag[6],
        "demand_pct_change_1m": F.try_divide(now - lag[1], lag[1]),
        "demand_pct_change_3m": F.try_divide(now - lag[3], lag[3]),
    }


def season_columns(order="month") -> dict:
    """``is_q4`` is the calendar quarter."""
    month = F.month(order)
    angle = month * (2 * math.pi / 12)
    return {
        "month_of_year": month,
        "quarter": F.quarter(order),
        "is_q4": F.when(F.quarter(order) == 4, 1).otherwise(0),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
    }


def risk_columns(df: DataFrame, order="month", series=None) -> dict:
    """Interactions and lags of those risk columns the frame has."""
    window = series_window(series, order)

    def lag(name, k=1):
        return F.lag(name, k).over(window)

    out, have = {}, set(df.columns)
    if {"geo_risk_index", "tariff_risk_index"} <= have:
        out["combined_risk_interaction"] = F.col("geo_risk_index") * F.col("tariff_risk_index")
        out["geo_risk_lag_1m"] = lag("geo_risk_index")
        out["tariff_risk_lag_1m"] = lag("tariff_risk_index")
    if "commodity_cost_pressure" in have:
        out["commodity_lag_1m"] = lag("commodity_cost_pressure")
        out["commodity_trend_3m"] = lag("commodity_cost_pressure") - lag("commodity_cost_pressure", 3)
    if "weather_disruption_index" in have:
        out["weather_lag_1m"] = lag("weather_disruption_index")
    return out


def lag_features(df: DataFrame, **kw) -> DataFrame:
    return df.withColumns(lag_columns(**kw))


def rolling_features(df: DataFrame, **kw) -> DataFrame:
    return df.withColumns(rolling_columns(**kw))


def trend_features(df: DataFrame, **kw) -> DataFrame:
    return df.withColumns(trend_columns(**kw))


def demand_features(df: DataFrame, *, target=TARGET, order="month", series=None, lags=(1, 3, 6, 12),
                    windows=(3, 6, 12), parity=False, drop_incomplete=True) -> DataFrame:
    """The whole feature frame.  ``parity`` keeps the two change rates that use the
    current target, which leak it; they are left out by default.  Rows with a NULL
    feature are dropped."""
    common = {"target": target, "order": order, "series": series}
    trends = trend_columns(**common)
    if not parity:
        trends = {n: c for n, c in trends.items() if "pct_change" not in n}
    start = F.min(order).over(series_window(series, order).rowsBetween(Window.unboundedPreceding, 0))
    made = {
        **lag_columns(lags=lags, **common),
        **rolling_columns(windows=windows, **common),
        **trends,
        **season_columns(order),
        **risk_columns(df, order, series),
        "months_since_start": F.datediff(order, start) / 30.44,
    }
    out = df.withColumns(made)
    return out.dropna(subset=list(made)) if drop_incomplete else out


def feature_columns(df: DataFrame, exclude=TARGET_PARTS, series=None) -> list[str]:
    """Numeric columns that are no part of the target and no key."""
    skip = {*exclude, *as_list(series)}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def temporal_split(df: DataFrame, order="month", series=None, test=12) -> DataFrame:
    """Adds ``split``: the last ``test`` rows of each series are TEST, the rest TRAIN."""
    age = F.row_number().over(series_window(series, F.col(order).desc()))
    return df.withColumn("split", F.when(age <= test, "TEST").otherwise("TRAIN"))


def calendar_events(spark: SparkSession, years, events=None) -> DataFrame:
    """The yearly events of each year, with the dates their windows span."""
    events = K.CALENDAR_EVENTS if events is None else events
    table = literal_rows(spark, events, ["event", "month_no", "day_no", "before", "after"])
    year = F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("year")
    day = F.make_date("year", "month_no", "day_no")
    return table.select("*", year).select(
        "event", "year", day.alias("event_date"),
        F.date_sub(day, F.col("before")).alias("window_start"),
        F.date_add(day, F.col("after")).alias("window_end"),
    )


def event_flags(month: Column, events=None) -> dict:
    """One 0/1 column per yearly event: does its window overlap the month."""
    events = K.CALENDAR_EVENTS if events is None else events
    last = F.last_day(month)
    out = {}
    for name, month_no, day_no, before, after in events:
        hit = F.lit(False)
        for shift in (-1, 0, 1):
            day = F.make_date(F.year(month) + shift, F.lit(month_no), F.lit(day_no))
            hit = hit | ((F.date_sub(day, before) <= last) & (F.date_add(day, after) >= month))
        out[name] = F.when(hit, 1).otherwise(0)
    return out
