"""Distance on the globe."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: mean earth radius in kilometres, digits kept
EARTH_RADIUS_KM = 6371
DISTANCE_DIGITS = 2


def _haversine(angle: Column) -> Column:
    half = F.sin(angle / 2)
    return half * half


def distance_km(latitude: Column, longitude: Column, to_latitude: Column, to_longitude: Column) -> Column:
    """Great-circle distance in kilometres, rounded half up; null if any coordinate is null.

    Rounding can push the haversine of two opposite points just above 1, which must not make
    the root below it fail.
    """
    share = _haversine(F.radians(to_latitude - latitude)) + (
        F.cos(F.radians(latitude))
        * F.cos(F.radians(to_latitude))
        * _haversine(F.radians(to_longitude - longitude))
    )
    central_angle = F.atan2(F.sqrt(share), F.sqrt(F.greatest(1 - share, F.lit(0.0))))
    return F.round(central_angle * (2 * EARTH_RADIUS_KM), DISTANCE_DIGITS)
