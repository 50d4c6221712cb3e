"""Great-circle distance as a plain Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightloom.functions.casting import stable_round

EARTH_RADIUS_KM = 6371
TRUCK_SPEED_KMH = 80.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, places: int | None = 2) -> Column:
    """Haversine distance in km between points given in degrees."""
    lat1, lon1, lat2, lon2 = (c.cast("double") for c in (lat1, lon1, lat2, lon2))
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), F.lit(2))
    )
    # rounding can push the argument of asin just past 1 for antipodes; least() skips NULLs, so guard it
    unit = F.when(chord.isNotNull(), F.least(F.sqrt(chord), F.lit(1.0)))
    km = F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(unit)
    return km if places is None else stable_round(km, places)


def expected_transit_hours(distance_km: Column, speed_kmh: float = TRUCK_SPEED_KMH) -> Column:
    return distance_km / F.lit(speed_kmh)


def leg_type(origin: Column, destination: Column) -> Column:
    """Lane role from the endpoint prefixes."""
    from_origin, to_node = origin.startswith("ON_"), destination.startswith("DN_")
    return (
        F.when(from_origin & to_node, "direct")
        .when(from_origin & destination.startswith("CH_"), "indirect_leg1")
        .when(origin.startswith("CH_") & to_node, "indirect_leg2")
        .otherwise("unknown")
    )
