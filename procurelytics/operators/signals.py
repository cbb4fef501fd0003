"""The monthly demand signal table: a month spine with every signal joined to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from procurelytics import constants as K
from procurelytics.functions.bands import band, ratio
from procurelytics.functions.dates import fiscal_quarter, fiscal_year

# columns each input brings, with the type used where the input is absent
SIGNAL_COLUMNS = {
    "prime": {"prime_obligations_usd": "double", "prime_action_count": "bigint", "unique_awards": "bigint",
              "avg_obligation_per_action": "double"},
    "sub": {"subaward_obligations_usd": "double", "subaward_count": "bigint", "unique_suppliers": "bigint"},
    "geo": {"geo_risk_index": "double", "geo_risk_max": "double", "geo_event_count": "bigint",
            "geo_critical_events": "bigint"},
    "trade": {"tariff_risk_index": "double", "trade_event_count": "bigint", "trade_critical_events": "bigint",
              "trade_affected_value_usd": "double"},
    "commodity": {"commodity_cost_pressure": "double", "commodity_avg_1mo_change": "double",
                  "commodity_avg_3mo_change": "double", "commodity_max_volatility": "double"},
    "weather": {"weather_disruption_index": "double", "weather_disruption_max": "double",
                "total_extreme_heat_days": "bigint", "total_extreme_cold_days": "bigint",
                "total_storm_events": "bigint"},
}


def fill_zero(df: DataFrame, keys=("month",)) -> DataFrame:
    """0 for NULL in every numeric column that is no key."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.fillna(0, subset=numeric)


def trade_signal(trade: DataFrame) -> DataFrame:
    """The columns the signal table takes from the monthly trade risk table."""
    return trade.select(
        "month", "tariff_risk_index", F.col("event_count").alias("trade_event_count"),
        F.col("critical_events").alias("trade_critical_events"),
        F.col("total_affected_value_usd").alias("trade_affected_value_usd"),
    )


def _on_own_months(sides) -> DataFrame:
    """One row per month from the least to the greatest month of any side, with the columns of all:
    each side is read once, its monthly rows are stacked, merged by month, and gaps are filled by
    rows of NULL.  The window runs over months."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.where("month is not null") for s in sides])
    values = [c for c in stacked.columns if c != "month"]
    merged = stacked.groupBy("month").agg(*[F.max(c).alias(c) for c in values])
    until = F.coalesce(F.add_months(F.lead("month").over(Window.orderBy("month")), -1), F.col("month"))
    rows = merged.withColumn("_until", until).withColumn("_m", F.explode(F.sequence("month", "_until", F.expr("interval 1 month"))))
    return rows.select(F.col("_m").alias("month"), *[F.when(F.col("_m") == F.col("month"), F.col(c)).alias(c) for c in values])


def unified_demand_signals(spine: DataFrame | None = None, *, prime=None, sub=None, sub_pivot=None, geo=None, trade=None,
                           commodity=None, weather=None, weights=None) -> DataFrame:
    """All monthly signals side by side, zero fill, then totals, ratio, risk and fiscal columns.
    With ``spine`` its months count, else all from the least to the greatest month of any side.  Every side has at most one row per month; any may be absent
    and then counts as zero.  ``sub_pivot`` may also come inside ``sub``."""
    weights = K.COMBINED_RISK_WEIGHTS if weights is None else weights
    given = {"prime": prime, "sub": sub, "geo": geo, "trade": trade, "commodity": commodity, "weather": weather}
    sides = [f for f in [*given.values(), sub_pivot] if f is not None]
    wide = _on_own_months(sides) if spine is None else reduce(lambda left, right: left.join(right, "month", "left"), sides, spine)
    absent = {
        name: F.lit(0).cast(kind)
        for key, columns in SIGNAL_COLUMNS.items() if given[key] is None
        for name, kind in columns.items()
    }
    filled = fill_zero(wide.withColumns(absent) if absent else wide)
    risk = sum(
        (F.abs(name) if name == "commodity_cost_pressure" else F.col(name)) * weight
        for name, weight in weights.items()
    )
    return filled.withColumns({
        "total_obligations_usd": F.col("prime_obligations_usd") + F.col("subaward_obligations_usd"),
        "subaward_ratio": ratio(F.col("subaward_obligations_usd"), F.col("prime_obligations_usd")),
        "combined_risk_index": risk,
        "risk_level": band(risk, K.COMBINED_RISK_BANDS, "MODERATE"),
        "fiscal_year": fiscal_year(F.col("month")),
        "fiscal_quarter": fiscal_quarter(F.col("month")),
    })


def signals_summary(signals: DataFrame) -> DataFrame:
    return signals.agg(
        F.count("*").alias("total_months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.sum("prime_obligations_usd").alias("total_prime_obligations"),
        F.sum("subaward_obligations_usd").alias("total_subaward_obligations"),
        F.avg("prime_obligations_usd").alias("avg_monthly_prime"),
        F.avg("subaward_obligations_usd").alias("avg_monthly_subaward"),
        F.avg("geo_risk_index").alias("avg_geo_risk"),
        F.avg("tariff_risk_index").alias("avg_tariff_risk"),
        F.avg("weather_disruption_index").alias("avg_weather_risk"),
        F.avg("commodity_cost_pressure").alias("avg_commodity_pressure"),
        F.avg("combined_risk_index").alias("avg_combined_risk"),
    )
