"""Weather flags and the disruption index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import band, ladder, lookup


def weather_flags(obs: DataFrame) -> DataFrame:
    """Day estimates and labels from monthly extremes; a missing reading counts as
    nothing unusual."""
    tmax, tmin, prcp, wind = F.col("tmax"), F.col("tmin"), F.col("prcp"), F.col("wspd")
    return obs.withColumns({
        "extreme_heat_days": F.when(tmax > K.EXTREME_HEAT_C, K.EXTREME_DAYS_ESTIMATE).otherwise(0),
        "extreme_cold_days": F.when(tmin < K.EXTREME_COLD_C, K.EXTREME_DAYS_ESTIMATE).otherwise(0),
        "precipitation_anomaly": band(prcp, K.PRECIPITATION_BANDS, "NORMAL"),
        "storm_event_count": ladder([((prcp > 80) & (wind > 15), 3), ((prcp > 50) | (wind > 20), 1)], 0),
        "snow_disruption_risk": band(F.col("snow"), K.SNOW_BANDS, "NONE"),
    })


def weather_index(obs: DataFrame) -> DataFrame:
    flagged = weather_flags(obs)
    extremes = (F.col("extreme_heat_days") + F.col("extreme_cold_days")) / 30 * 25
    points = (
        lookup(F.col("precipitation_anomaly"), K.PRECIPITATION_POINTS, 0)
        + F.col("storm_event_count") * 10
        + lookup(F.col("snow_disruption_risk"), K.SNOW_POINTS, 0)
    )
    scored = flagged.withColumn("weather_disruption_index", F.least(extremes + points, F.lit(100.0)))
    return scored.withColumn(
        "disruption_risk_level", band(F.col("weather_disruption_index"), K.DISRUPTION_BANDS, "LOW")
    )


def high_weather_events(weather: DataFrame, n=20) -> DataFrame:
    """Newest and then worst HIGH months; ties by location."""
    return (
        weather.where(F.col("disruption_risk_level") == "HIGH")
        .orderBy(F.col("month").desc(), F.col("weather_disruption_index").desc(), "location_id")
        .limit(n)
        .select("month", "location_id", "weather_disruption_index", "extreme_heat_days",
                "extreme_cold_days", "storm_event_count", "snow")
    )
