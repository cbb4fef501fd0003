"""Great-circle distance as a native expression (NULL coordinates give NULL)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from procurelytics.constants import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    return F.lit(2.0) * F.asin(F.sqrt(chord)) * EARTH_RADIUS_KM
