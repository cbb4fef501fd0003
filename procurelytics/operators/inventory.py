"""Inventory planning measures from monthly demand, for one series or many."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import band, ladder, lookup, ratio
from procurelytics.functions.dates import days_in_month
from procurelytics.operators.ranking import series_window

GOLD_COLUMNS = [
    "month", "fiscal_year", "fiscal_quarter", "demand_proxy_usd", "avg_daily_demand_proxy",
    "demand_6mo_avg", "demand_12mo_avg", "demand_stddev_proxy", "coefficient_of_variation",
    "demand_volatility_category", "lead_time_days_assumed", "lead_time_demand", "safety_stock_proxy",
    "risk_adjusted_safety_stock", "requirements_objective_proxy", "risk_adjusted_ro",
    "approved_acquisition_objective_proxy", "days_of_supply_proxy", "inventory_turnover_proxy",
    "reorder_point", "combined_risk_index", "risk_level", "nmcs_risk_indicator",
    "forecast_method_recommendation",
]


def rolling_demand_stats(df: DataFrame, *, value="total_obligations_usd", order="month", series=None,
                         windows=(3, 6, 12)) -> DataFrame:
    """Trailing mean and sample deviation over the rows there are (a short history gives
    short frames; one row has no deviation), daily demand and variation."""
    demand = F.col(value)
    rolled = {}
    for k in windows:
        frame = series_window(series, order).rowsBetween(1 - k, 0)
        rolled[f"demand_{k}mo_avg"] = F.avg(demand).over(frame)
        rolled[f"demand_stddev_{k}mo"] = F.stddev_samp(demand).over(frame)
    days = days_in_month(F.col(order))
    return df.withColumns({
        "demand_proxy_usd": demand,
        "days_in_month": days,
        "avg_daily_demand_proxy": demand / days,
        **rolled,
    }).withColumns({
        "demand_stddev_proxy": F.coalesce("demand_stddev_6mo", "demand_stddev_3mo", F.lit(0.0)),
        "coefficient_of_variation": ratio(F.col("demand_stddev_6mo"), F.col("demand_6mo_avg")),
    })


def inventory_metrics(stats: DataFrame, *, procurement_days=K.PROCUREMENT_LEAD_DAYS, admin_days=K.ADMIN_LEAD_DAYS,
                      safety_factor=K.SAFETY_FACTOR, operating_days=K.OPERATING_LEVEL_DAYS,
                      acquisition_years=K.ACQUISITION_YEARS) -> DataFrame:
    """Lead-time demand, safety stock, reorder point, requirements and acquisition
    objective, days of supply and turnover."""
    lead = procurement_days + admin_days
    daily, yearly = F.col("avg_daily_demand_proxy"), F.col("demand_12mo_avg")
    requirement = F.col("operating_level_demand") + F.col("lead_time_demand") + F.col("safety_stock_proxy")
    staged = stats.withColumns({
        "lead_time_days_assumed": F.lit(lead),
        "lead_time_demand": daily * lead,
        "safety_stock_proxy": F.col("demand_stddev_proxy") * (safety_factor * (lead / 30) ** 0.5),
        "operating_level_demand": daily * operating_days,
        "two_year_forecast_demand": yearly * (12 * acquisition_years),
    }).withColumns({
        "reorder_point": F.col("lead_time_demand") + F.col("safety_stock_proxy"),
        "requirements_objective_proxy": requirement,
    })
    objective = F.col("requirements_objective_proxy")
    return staged.withColumns({
        "approved_acquisition_objective_proxy": objective + F.col("two_year_forecast_demand"),
        "days_of_supply_proxy": ratio(objective, daily),
        "inventory_turnover_proxy": ratio(yearly * 12, objective),
    })


def inventory_risk(metrics: DataFrame) -> DataFrame:
    """Risk-adjusted stock, volatility class, recommended method and supply risk."""
    days, risk = F.col("days_of_supply_proxy"), F.col("combined_risk_index")
    adjusted = F.col("safety_stock_proxy") * (1 + risk / 100)
    volatility = band(F.col("coefficient_of_variation"), K.VOLATILITY_BANDS, "STABLE")
    return metrics.withColumns({
        "risk_adjusted_safety_stock": adjusted,
        "risk_adjusted_ro": F.col("operating_level_demand") + F.col("lead_time_demand") + adjusted,
        "demand_volatility_category": volatility,
        "nmcs_risk_indicator": ladder([
            ((days < 30) & (risk > 40), "HIGH_RISK"),
            ((days < 60) | (risk > 30), "ELEVATED_RISK"),
        ], "NORMAL"),
    }).withColumn(
        "forecast_method_recommendation", lookup(F.col("demand_volatility_category"), K.METHOD_BY_VOLATILITY)
    )


def inventory_metrics_gold(df: DataFrame, *, series=()) -> DataFrame:
    """The published columns, in order."""
    return df.select(*series, *GOLD_COLUMNS)


def inventory_table(signals: DataFrame, *, value="total_obligations_usd", series=None) -> DataFrame:
    """Signals to the published metrics, all steps."""
    stats = rolling_demand_stats(signals, value=value, series=series)
    keys = [] if series is None else [series] if isinstance(series, str) else list(series)
    return inventory_metrics_gold(inventory_risk(inventory_metrics(stats)), series=keys)


def metrics_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.avg("demand_proxy_usd").alias("avg_monthly_demand"),
        F.avg("avg_daily_demand_proxy").alias("avg_daily_demand"),
        F.avg("demand_stddev_proxy").alias("avg_demand_stddev"),
        F.avg("safety_stock_proxy").alias("avg_safety_stock"),
        F.avg("requirements_objective_proxy").alias("avg_requirements_objective"),
        F.avg("days_of_supply_proxy").alias("avg_days_of_supply"),
    )


def metrics_latest(metrics: DataFrame) -> DataFrame:
    """The newest row with its supply status."""
    newest = metrics.orderBy(F.col("month").desc()).limit(1)
    return newest.select(
        "month", "requirements_objective_proxy", "risk_adjusted_ro", "approved_acquisition_objective_proxy",
        "days_of_supply_proxy", band(F.col("days_of_supply_proxy"), K.SUPPLY_DAYS_BANDS, "CRITICAL").alias("supply_status"),
        "nmcs_risk_indicator", "demand_volatility_category", "coefficient_of_variation",
        "forecast_method_recommendation",
    )
