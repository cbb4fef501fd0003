"""What-if tables: one row per scenario, all against one baseline.

The baseline is the mean of the last twelve months: a scalar subquery, computed
once and shared by every scenario row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import ladder, lookup
from procurelytics.operators.ranking import tail_n


def baseline(signals: DataFrame, months=12, value="total_obligations_usd") -> Column:
    return tail_n(signals, months).agg(F.avg(value)).scalar()


def _with_baseline(signals: DataFrame, scenarios: DataFrame) -> DataFrame:
    return scenarios.withColumn("baseline_monthly", baseline(signals))


def scenario_geo(signals: DataFrame, scenarios: DataFrame) -> DataFrame:
    """``scenarios``: risk_level, region.  An unknown level changes nothing."""
    factor = lookup(F.upper("risk_level"), K.GEO_MULTIPLIERS, 1.0)
    action = ladder([
        (F.upper("risk_level") == "CRITICAL", "Activate surge capacity"),
        (F.upper("risk_level") == "HIGH", "Accelerate procurement"),
        (F.upper("risk_level") == "ELEVATED", "Review contingency plans"),
    ], "Continue normal operations")
    out = _with_baseline(signals, scenarios).withColumn("multiplier", factor)
    return out.withColumns({
        "projected_monthly": F.col("baseline_monthly") * F.col("multiplier"),
        "annual_impact": (F.col("multiplier") - 1) * F.col("baseline_monthly") * 12,
        "action": action,
    })


def scenario_tariff(signals: DataFrame, scenarios: DataFrame, *, import_share=K.IMPORT_SHARE) -> DataFrame:
    """``scenarios``: tariff_increase_pct, product_category."""
    pct = F.col("tariff_increase_pct")
    action = ladder([(pct >= 50, "Evaluate domestic sourcing"), (pct >= 25, "Diversify suppliers")], "Monitor developments")
    out = _with_baseline(signals, scenarios).withColumn("import_content", F.col("baseline_monthly") * import_share)
    return out.withColumn("monthly_tariff_cost", F.col("import_content") * pct / 100).withColumns({
        "share_of_spend_pct": F.try_divide(F.col("monthly_tariff_cost"), F.col("baseline_monthly")) * 100,
        "annual_impact": F.col("monthly_tariff_cost") * 12,
        "action": action,
    })


def scenario_weather(scenarios: DataFrame) -> DataFrame:
    """``scenarios``: disruption_type, affected_region.  An unknown type counts as a
    severe winter.  Recovery takes the delay and a week; ten days or more call for
    emergency logistics."""
    default = K.WEATHER_IMPACTS["SEVERE_WINTER"]
    kind = F.upper("disruption_type")

    def of(position, convert=lambda v: v):
        return lookup(kind, {k: convert(v[position]) for k, v in K.WEATHER_IMPACTS.items()}, convert(default[position]))

    out = scenarios.withColumns({
        "delay_days": of(0),
        "production_impact_pct": of(1),
        "affected_subsystems": of(2, ", ".join),
    })
    return out.withColumns({
        "recovery_days": F.col("delay_days") + 7,
        "action": F.when(F.col("delay_days") >= 10, "Activate emergency logistics").otherwise("Monitor forecasts"),
    })


def scenario_whatif(signals: DataFrame, scenarios: DataFrame, *, elasticities=None) -> DataFrame:
    """``scenarios``: geo_risk_pct, tariff_pct, commodity_price_pct, demand_shock_pct."""
    e = K.ELASTICITIES if elasticities is None else elasticities
    effects = {
        "geo_effect_pct": F.col("geo_risk_pct") * e["geo_risk"],
        "tariff_effect_pct": F.col("tariff_pct") * e["tariff"],
        "commodity_effect_pct": F.col("commodity_price_pct") * e["commodity_price"],
    }
    out = _with_baseline(signals, scenarios).withColumns(effects)
    net = sum((F.col(name) for name in effects), F.col("demand_shock_pct"))
    return out.withColumn("net_impact_pct", net).withColumns({
        "projected_monthly": F.col("baseline_monthly") * (1 + F.col("net_impact_pct") / 100),
        "monthly_change": F.col("baseline_monthly") * F.col("net_impact_pct") / 100,
        "annual_impact": F.col("baseline_monthly") * F.col("net_impact_pct") / 100 * 12,
    })
