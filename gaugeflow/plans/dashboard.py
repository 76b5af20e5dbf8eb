"""Everything one dashboard refresh shows, read from the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from gaugeflow.operators.metrics import overview_metrics
from gaugeflow.params import DEFAULTS, Params
from gaugeflow.plans import serving
from gaugeflow.schema import FRAMES, conform
from gaugeflow.sources.store import StationStore


def dashboard_frames(
    store: StationStore,
    as_of: Column,
    params: Params = DEFAULTS,
    selected_cities: Sequence[str] = (),
    focus: str = serving.FOCUS_ALL,
) -> dict[str, DataFrame]:
    """Headline metrics, freshness and the eight serving frames, in their order.

    The city choice applies to the frames and the station focus to the map's rows; metrics and
    freshness always cover the whole network. Nothing is computed until a frame is read.
    """
    latest = store.gold("latest_station_status")
    critical = store.gold("critical_stations")
    log = store.alerts()
    frames = {
        "latest": serving.serve_latest(latest),
        "top_stations": serving.serve_top_stations(
            store.gold("top_utilization_stations"), params.top_station_limit
        ),
        "city_summary": serving.serve_city_summary(latest, params),
        "zones": serving.serve_zones(store.gold("low_availability_zones")),
        "peaks": serving.serve_peaks(store.gold("daily_usage_peaks")),
        "critical": serving.serve_critical(critical),
        "alerts": serving.recent_alerts(log),
        "imbalance": serving.serve_imbalance(store.gold("geographic_imbalance")),
    }
    options = serving.city_options(latest)
    shown = {
        name: conform(serving.filter_cities(frame, selected_cities, options), FRAMES[name])
        for name, frame in frames.items()
    }
    shown["map"] = serving.focus_stations(shown["latest"], focus, params)
    shown["metrics"] = overview_metrics(latest, critical, log, as_of)
    shown["freshness"] = serving.freshness(latest, as_of, params)
    shown["city_options"] = options
    return shown
