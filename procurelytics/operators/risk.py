"""Geographic, concentration and trade risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import band, lookup
from procurelytics.functions.dates import as_date, month_of
from procurelytics.functions.geo import haversine_km
from procurelytics.operators.ranking import as_list, series_window


def enrich(df: DataFrame, dim: DataFrame, on, defaults: dict) -> DataFrame:
    """Left join to a dimension with defaults for what it lacks.  The join strategy
    follows the dimension's measured size: broadcast below Spark's threshold, a
    shuffle join above it."""
    return df.join(dim, on, "left").withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()
    })


def region_lookup(df: DataFrame, country_col: str, mapping=None) -> DataFrame:
    mapping = K.COUNTRY_REGION if mapping is None else mapping
    return df.withColumn("region_group", lookup(F.col(country_col), mapping, "OTHER"))


def distance_to(df: DataFrame, lat="lat", lon="lon", point=K.HOME_SITE, name="distance_to_hq_km") -> DataFrame:
    distance = haversine_km(F.col(lat), F.col(lon), F.lit(float(point[0])), F.lit(float(point[1])))
    return df.withColumn(name, distance)


def nearest_facility(points: DataFrame, facilities, lat="lat", lon="lon") -> DataFrame:
    """Nearest of a short list of ``(name, lat, lon)`` sites.  The list becomes an
    expression per row, so no pairs of rows are formed."""
    options = F.array(*[
        F.struct(
            haversine_km(F.col(lat), F.col(lon), F.lit(float(flat)), F.lit(float(flon))).alias("km"),
            F.lit(name).alias("facility"),
        )
        for name, flat, flon in facilities
    ])
    best = F.array_min(options)
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return points.withColumns({
        "nearest_facility": F.when(known, best["facility"]),
        "nearest_km": F.when(known, best["km"]),
    })


def geographic_risk(df: DataFrame, region_col="region_group", distance_col="distance_to_hq_km") -> DataFrame:
    """Supplier count and distances per region with the region's risk level."""
    return df.groupBy(region_col).agg(
        F.count("*").alias("supplier_count"),
        F.avg(distance_col).alias("avg_distance_km"),
        F.max(distance_col).alias("max_distance_km"),
    ).withColumn("geographic_risk_level", lookup(F.col(region_col), K.REGION_RISK, "UNKNOWN"))


def supplier_concentration(df: DataFrame, category_col: str, supplier_col: str, amount_col: str) -> DataFrame:
    """Distinct suppliers and spend per category.  Amounts are first summed per category
    and supplier, so that the distinct count works on the reduced rows."""
    pairs = df.groupBy(category_col, supplier_col).agg(F.sum(amount_col).alias("spend"))
    out = pairs.groupBy(category_col).agg(
        F.count(supplier_col).alias("num_suppliers"),
        F.sum("spend").alias("total_spend"),
    )
    return out.withColumn("concentration_risk", band(F.col("num_suppliers"), K.CONCENTRATION_BANDS, "LOW"))


# --- trade events ---------------------------------------------------------------
def is_negative(event_type: Column) -> Column:
    return F.coalesce(event_type.isin(K.NEGATIVE_EVENT_TYPES), F.lit(False))


def product_category(hts_code: Column) -> Column:
    return lookup(F.substring(hts_code, 1, 2), K.PRODUCT_PREFIXES, "OTHER")


def trade_events_silver(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "event_date": as_date(F.col("event_date")),
        "effective_date": as_date(F.col("effective_date")),
        "event_month": month_of(F.col("event_date")),
        "is_negative_event": is_negative(F.col("event_type")),
        "product_category": product_category(F.col("hts_code")),
    })


def trade_risk_base(events: DataFrame, *, month_col="event_month", partition_by=None) -> DataFrame:
    """Monthly event counts, severities, values and breadth.  Rows are first reduced per
    month, country and product code; the two distinct counts then run on that
    reduced set instead of on a doubled copy of the events."""
    keys = [*as_list(partition_by), month_col]

    def hits(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    cells = events.groupBy(*keys, "country_code", "hts_code").agg(
        F.count("*").alias("n"),
        hits(F.col("is_negative_event")).alias("negative"),
        F.sum("impact_score").alias("impact"), F.count("impact_score").alias("impact_n"),
        F.max("impact_score").alias("impact_max"),
        F.sum("affected_value_usd").alias("value"),
        F.sum("rate_change_pct").alias("rate"), F.count("rate_change_pct").alias("rate_n"),
        hits(F.col("severity") == "CRITICAL").alias("critical"),
        hits(F.col("severity") == "HIGH").alias("high"),
    )
    return cells.groupBy(*as_list(partition_by), F.col(month_col).alias("month")).agg(
        F.sum("n").alias("event_count"),
        F.sum("negative").alias("negative_event_count"),
        F.try_divide(F.sum("impact"), F.sum("impact_n")).alias("avg_impact_score"),
        F.max("impact_max").alias("max_impact_score"),
        F.sum("value").alias("total_affected_value_usd"),
        F.try_divide(F.sum("rate"), F.sum("rate_n")).alias("avg_rate_change_pct"),
        F.sum("critical").alias("critical_events"),
        F.sum("high").alias("high_events"),
        F.count_distinct("country_code").alias("countries_affected"),
        F.count_distinct("hts_code").alias("product_categories_affected"),
    )


def trade_risk_index(events: DataFrame, *, month_col="event_month", partition_by=None, cap=100) -> DataFrame:
    """Index = percent rank of the event count (25) + severity per event (35) + mean
    impact (25) + breadth (15); only the sum is capped.  The rank runs over one row per
    month (and ``partition_by`` key)."""
    base = trade_risk_base(events, month_col=month_col, partition_by=partition_by)
    rank = F.percent_rank().over(series_window(partition_by, "event_count"))
    severity = (F.col("critical_events") * 15 + F.col("high_events") * 8) / F.greatest(F.col("event_count"), F.lit(1))
    breadth = (F.col("countries_affected") + F.col("product_categories_affected")) / 20
    total = rank * 25 + severity * 35 + F.col("avg_impact_score") / 100 * 25 + breadth * 15
    return base.withColumn("tariff_risk_index", F.least(total, F.lit(float(cap)))).withColumn(
        "risk_level", band(F.col("tariff_risk_index"), K.TARIFF_RISK_BANDS, "MODERATE")
    )


def high_impact_events(events: DataFrame, n=20, severities=("CRITICAL", "HIGH")) -> DataFrame:
    """The newest events of the given severities; ties by event id."""
    return (
        events.where(F.col("severity").isin(*severities))
        .orderBy(F.col("event_date").desc(), "event_id")
        .limit(n)
        .select("event_id", "event_date", "event_type", "country_name", "hts_description", "severity", "impact_score")
    )
