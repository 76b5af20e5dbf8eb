"""Number formats of the operations dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording and the dead band of metric changes.
STABLE = "Stable"
RATE_DEAD_BAND = 0.0005


def grouped_count(value: Column) -> Column:
    return F.translate(F.format_number(value.cast("bigint"), 0), ",", " ")


def percent(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate.cast("double") * 100)


def percent_or_dash(rate: Column) -> Column:
    return F.when(rate.isNotNull(), percent(rate)).otherwise("-")


def _with_unit(text: Column, unit: str) -> Column:
    return F.concat(text, F.lit(f" {unit}")) if unit else text


def signed_count(delta: Column, unit: str = "") -> Column:
    return F.when(delta == 0, STABLE).otherwise(
        _with_unit(F.format_string("%+d", delta.cast("bigint")), unit)
    )


def signed_rate(delta: Column, unit: str = "") -> Column:
    return F.when(F.abs(delta) < RATE_DEAD_BAND, STABLE).otherwise(
        _with_unit(F.format_string("%+.1f", delta.cast("double") * 100), unit)
    )


def _direction(delta: Column, dead_band: float) -> Column:
    return (
        F.when(delta > dead_band, "up").when(delta < -dead_band, "down").otherwise("neutral")
    )


def count_direction(delta: Column) -> Column:
    return _direction(delta, 0)


def rate_direction(delta: Column) -> Column:
    return _direction(delta, RATE_DEAD_BAND)
