"""Landed rows to gold tables: plain composition of operators.

With a ``root`` folder every table is stored when it is ready and later steps read the
stored copy, so each fact table is scanned once; without one the whole flow stays lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from procurelytics.functions.dates import month_spine
from procurelytics.operators import inventory, prices, risk, rollups, signals, weather
from procurelytics.sinks.layers import write_layer


def supplier_locations(entities: DataFrame) -> DataFrame:
    """Flattened entities (with ``latitude`` and ``longitude``) to located suppliers."""
    named = entities.withColumnsRenamed({
        "legal_business_name": "supplier_name", "physical_address_city": "city",
        "physical_address_state_or_province": "state", "physical_address_country_code": "country",
        "latitude": "lat", "longitude": "lon",
    })
    return risk.distance_to(risk.region_lookup(named, "country")).select(
        "supplier_name", "uei", "cage_code", "city", "state", "country", "lat", "lon", "region_group",
        "distance_to_hq_km", "subsystem_category", "company_size", "naics_code_primary",
    )


def in_range(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Rows from the month of ``start`` to the month of ``end``, as a plain comparison on the
    stored column: it reaches the parquet scan, and the partitions if the table is
    partitioned by it.  Text dates are left to the month expression."""
    if isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        first, after = F.trunc(F.lit(start).cast("date"), "month"), F.add_months(F.trunc(F.lit(end).cast("date"), "month"), 1)
        return df.where((F.col(date_col) >= first) & (F.col(date_col) < after))
    return df


def build(spark: SparkSession, sources: dict, *, start: str, end: str, categories=(), price_source: str | None = None,
          root: str | None = None) -> dict[str, DataFrame]:
    """``sources`` may hold awards, subawards, trade_events, indicators, weather_obs,
    geo_risk and entities; what is absent counts as zero in the signals."""
    out: dict[str, DataFrame] = {}

    def keep(layer, name, df):
        out[name] = df if root is None else write_layer(df, f"{root.rstrip('/')}/{layer}/{name}")
        return out[name]

    def given(name, make):
        return make(sources[name]) if sources.get(name) is not None else None

    given("entities", lambda e: keep("silver", "supplier_locations", supplier_locations(e)))
    events = given("trade_events", lambda e: keep("silver", "trade_events", risk.trade_events_silver(e)))
    price = given("indicators", lambda i: keep(
        "silver", "commodity_monthly", prices.commodity_enriched(i, prices.series_metadata(spark), source=price_source)))
    wet = given("weather_obs", lambda o: keep("silver", "weather_monthly", weather.weather_index(o)))
    trade = None if events is None else keep("gold", "trade_risk_monthly", risk.trade_risk_index(events))
    table = signals.unified_demand_signals(
        month_spine(spark, start, end),
        prime=given("awards", lambda a: rollups.prime_monthly(in_range(a, "action_date", start, end))),
        sub=given("subawards", lambda s: rollups.subaward_monthly(
            in_range(s, "subaward_action_date", start, end), categories=categories)),
        geo=given("geo_risk", rollups.geo_risk_monthly),
        trade=None if trade is None else signals.trade_signal(trade),
        commodity=None if price is None else rollups.commodity_pressure_monthly(price),
        weather=None if wet is None else rollups.weather_monthly(wet),
    )
    demand = keep("gold", "demand_signals", table)
    keep("gold", "inventory_metrics", inventory.inventory_table(demand))
    return out
