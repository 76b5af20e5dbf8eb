"""Thresholds and widths that change results; every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    low_availability_threshold: float = 2.0
    critical_bikes_threshold: int = 2
    critical_utilization_threshold: float = 0.85
    top_station_limit: int = 10
    poll_interval_seconds: int = 60
    watermark: str = "10 minutes"
    rolling_window_seconds: int = 15 * 60
    zone_decimals: int = 2
    focus_bikes: int = 2
    focus_utilization: float = 0.85
    supported_countries: tuple[str, ...] = ("FR", "FRA")
    display_timezone: str = "Europe/Paris"
    # Widths of the time slices that spread one station's history over many tasks.
    lag_bucket_seconds: int = 24 * 3600
    rolling_bucket_seconds: int = 2 * 3600


DEFAULTS = Params()
