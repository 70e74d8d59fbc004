"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance by the haversine formula; NULL when a coordinate is missing."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_turn_lat = F.sin((phi_b - phi_a) / 2)
    half_turn_lng = F.sin((F.radians(lng_b) - F.radians(lng_a)) / 2)
    chord = half_turn_lat * half_turn_lat + (
        F.cos(phi_a) * F.cos(phi_b) * half_turn_lng * half_turn_lng
    )
    # Rounding may push the chord of two opposite points a hair above 1. (``least`` would turn a
    # missing coordinate into the longest distance.)
    bounded = F.when(chord > 1, 1.0).otherwise(chord)
    return F.asin(F.sqrt(bounded)) * (2 * EARTH_RADIUS_KM)
