"""Monthly and grouped roll-ups: one partial aggregate on the map side, one shuffle of
the reduced rows.  No group is ever gathered row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.functions.dates import month_of
from procurelytics.operators.ranking import as_list


def distinct_count(name, approx: bool = False) -> Column:
    """Exact by default; ``approx`` swaps the second shuffle of an exact distinct
    count for a sketch of fixed size."""
    return F.approx_count_distinct(name) if approx else F.count_distinct(F.col(name) if isinstance(name, str) else name)


def monthly_rollup(df: DataFrame, date_col: str, measures: dict, *, series=None) -> DataFrame:
    month = month_of(F.col(date_col)).alias("month")
    return df.groupBy(*as_list(series), month).agg(*[m.alias(name) for name, m in measures.items()])


def prime_monthly(awards: DataFrame, *, series=None, approx=False) -> DataFrame:
    amount = F.col("federal_action_obligation")
    return monthly_rollup(awards, "action_date", {
        "prime_obligations_usd": F.sum(amount),
        "prime_action_count": F.count("*"),
        "unique_awards": distinct_count("award_id_piid", approx),
        "avg_obligation_per_action": F.avg(amount),
    }, series=series)


def subsystem_column(category) -> str:
    return f"subsystem_{'null' if category is None else str(category).lower()}_usd"


def _subsystem_sums(categories) -> dict:
    category, amount = F.col("subsystem_category"), F.col("subaward_amount")
    return {
        subsystem_column(c): F.sum(F.when(category.eqNullSafe(F.lit(c)), amount)) for c in categories
    }


def subaward_monthly(subawards: DataFrame, *, categories=(), series=None, approx=False) -> DataFrame:
    """Totals per month and, for the named ``categories``, the pivoted sums from the
    same scan."""
    return monthly_rollup(subawards, "subaward_action_date", {
        "subaward_obligations_usd": F.sum("subaward_amount"),
        "subaward_count": F.count("*"),
        "unique_suppliers": distinct_count("sub_awardee_name", approx),
        **_subsystem_sums(categories),
    }, series=series)


def pivot_monthly(df: DataFrame, date_col: str, category_col: str, amount_col: str, categories) -> DataFrame:
    """Month by category sums.  ``categories`` names the output columns, which saves the
    job that would list them; None stands for rows without a category."""
    month = month_of(F.col(date_col)).alias("month")
    keyed = df.select(month, F.coalesce(F.col(category_col), F.lit("null")).alias("c"), F.col(amount_col).alias("a"))
    names = ["null" if c is None else c for c in categories]
    wide = keyed.groupBy("month").pivot("c", names).agg(F.sum("a"))
    return wide.withColumnsRenamed({n: subsystem_column(n) for n in names})


def geo_risk_monthly(geo: DataFrame) -> DataFrame:
    return monthly_rollup(geo, "month", {
        "geo_risk_index": F.avg("composite_risk_index"),
        "geo_risk_max": F.max("composite_risk_index"),
        "geo_event_count": F.sum("event_count"),
        "geo_critical_events": F.sum("critical_events"),
    })


def commodity_pressure_monthly(prices: DataFrame) -> DataFrame:
    return monthly_rollup(prices, "month", {
        "commodity_cost_pressure": F.avg("cost_pressure_score"),
        "commodity_avg_1mo_change": F.avg("pct_change_1mo"),
        "commodity_avg_3mo_change": F.avg("pct_change_3mo"),
        "commodity_max_volatility": F.max(F.abs("pct_change_1mo")),
    })


def weather_monthly(weather: DataFrame) -> DataFrame:
    return monthly_rollup(weather, "month", {
        "weather_disruption_index": F.avg("weather_disruption_index"),
        "weather_disruption_max": F.max("weather_disruption_index"),
        "total_extreme_heat_days": F.sum("extreme_heat_days"),
        "total_extreme_cold_days": F.sum("extreme_cold_days"),
        "total_storm_events": F.sum("storm_event_count"),
    })


def group_summary(df: DataFrame, by, measures: dict, order=(), limit: int | None = None) -> DataFrame:
    """Grouped measures, ordered, optionally the top rows.  ``order`` should end in the
    group key so that equal measures rank the same way every time."""
    out = df.groupBy(*as_list(by)).agg(*[m.alias(name) for name, m in measures.items()])
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)
