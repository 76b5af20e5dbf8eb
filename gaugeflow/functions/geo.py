"""Zone grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(value: Column, decimals: int) -> Column:
    # A decimal cast rounds and prints like round + "%.2f" at a fraction of the cost; the format
    # remains for what no decimal holds (not-a-number, infinity).
    exact = value.try_cast(f"decimal(18,{decimals})").cast("string")
    return F.coalesce(exact, F.format_string(f"%.{decimals}f", F.round(value, decimals)))


def zone_id(latitude: Column, longitude: Column, decimals: int) -> Column:
    """Grid cell of a position: both coordinates rounded, joined by an underscore."""
    return F.concat_ws("_", _fixed(latitude, decimals), _fixed(longitude, decimals))
