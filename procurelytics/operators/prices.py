"""Price series: changes, direction, volatility and cost pressure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import band
from procurelytics.operators.ranking import as_list, latest_period, series_window
from procurelytics.operators.risk import enrich
from procurelytics.sources.tables import literal_rows


def pct_changes(df: DataFrame, *, key="indicator_code", order="as_of_date", value="value", lags=(1, 3, 12)) -> DataFrame:
    """Percent change against earlier rows of the series; NULL where there is none or
    where it is 0.  One window serves all lags; a series has one row per month."""
    window = series_window(as_list(key), order)
    now = F.col(value)
    before = {k: F.lag(value, k).over(window) for k in lags}
    return df.withColumns({
        f"pct_change_{k}mo": F.when(old != 0, (now - old) / old * 100) for k, old in before.items()
    })


def commodity_scores(df: DataFrame, *, key="indicator_code", order="as_of_date", value="value", lags=(1, 3, 12)) -> DataFrame:
    """Adds changes, direction, volatility flag and cost pressure.  The first month of a
    series has no change and so takes the last label of each ladder."""
    out = pct_changes(df, key=key, order=order, value=value, lags=lags)
    change = F.col("pct_change_1mo")
    pressure = sum(
        (F.coalesce(F.col(f"pct_change_{k}mo"), F.lit(0.0)) * weight for k, weight in K.COST_PRESSURE_WEIGHTS.items()),
        F.lit(0.0),
    )
    return out.withColumns({
        "price_direction": band(change, K.PRICE_DIRECTION_BANDS, "FALLING_FAST"),
        "volatility_flag": band(F.abs(change), K.PRICE_VOLATILITY_BANDS, "LOW_VOLATILITY"),
        "cost_pressure_score": pressure,
    })


def series_metadata(spark, entries=None) -> DataFrame:
    """The price-series table: ticker, category and use."""
    entries = K.PRICE_SERIES if entries is None else entries
    rows = [(t, category, use) for t, (_, category, use, _) in entries.items()]
    return literal_rows(spark, rows, ["ticker", "category", "defense_use"])


def commodity_enriched(indicators: DataFrame, metadata: DataFrame, *, source: str | None = None) -> DataFrame:
    """Monthly price table: scores of the rows of ``source``, with category and use."""
    rows = indicators if source is None else indicators.where(F.col("source") == source)
    scored = commodity_scores(rows).withColumnRenamed("indicator_code", "ticker")
    joined = enrich(scored, metadata, "ticker", {"category": "OTHER", "defense_use": ""})
    return joined.select(
        F.col("as_of_date").alias("month"), "ticker", F.col("indicator_name").alias("commodity_name"),
        "category", "defense_use", "unit", F.col("value").alias("close_price"),
        "pct_change_1mo", "pct_change_3mo", "pct_change_12mo",
        F.col("as_of_date").alias("month_date"), "price_direction", "volatility_flag", "cost_pressure_score",
    )


def commodity_latest(prices: DataFrame, *, category: str | None = None) -> DataFrame:
    """Prices of the newest month of a stored table, with the mean pressure of the rows
    shown (one per series) and its band."""
    wanted = None if category is None else F.upper("category") == category.upper()
    rows = latest_period(prices, "month", wanted)
    mean = F.avg("cost_pressure_score").over(series_window(None))
    return rows.withColumn("avg_pressure", mean).withColumn(
        "pressure_level", band(F.col("avg_pressure"), K.PRESSURE_BANDS, "FAVORABLE")
    )
