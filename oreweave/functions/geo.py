"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius.
EARTH_KM = 6371.0088

_DECIMAL = r"^\s*[+\-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+\-]?\d+)?\s*$"


def decimal(text: Column) -> Column:
    """Double that a text reads as (blanks around, sign and exponent allowed), else null."""
    return F.when(text.rlike(_DECIMAL), F.trim(F.regexp_replace(text, r"\s", "")).try_cast("double"))


def in_range(lat: Column, lon: Column) -> Column:
    """True where both are known and in range; never null."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, null if any coordinate is null."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
