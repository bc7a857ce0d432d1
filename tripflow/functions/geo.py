"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# --- fixed values: earth radius in miles, kilometres per mile ---
EARTH_RADIUS_MILES = 3961
PER_MILE = {"mi": 1.0, "km": 1.60934}


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Distance between two points given in degrees."""
    if unit not in PER_MILE:
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    lat1, lon1, lat2, lon2 = map(as_col, (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(chord)) * F.lit(2.0 * EARTH_RADIUS_MILES * PER_MILE[unit])
