"""Edge-triggered alerts on a stream, with state per station."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gaugeflow.operators.alerts import CRITICAL, EMPTY, as_alerts
from gaugeflow.params import DEFAULTS, Params

_OUTPUT = (
    "station_key string, city string, station_id string, station_name string, "
    "snapshot_timestamp timestamp, bikes_available int, free_slots int, "
    "utilization_rate double, kinds array<string>"
)
_COLUMNS = [part.split()[0] for part in _OUTPUT.split(", ")]
# Microseconds and fullness of the readings still inside the window, and the flags last seen.
_STATE = "times array<bigint>, rates array<double>, empty boolean, critical boolean"


def stream_transitions(facts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Alerts for snapshots at which a station becomes empty or critical.

    Takes cleaned, deduplicated snapshots, streaming or batch. State is one window of readings
    per station. Snapshots that arrive behind one already handled change nothing. A station's rows
    are put in order per micro-batch, whose size the source's trigger limit bounds.
    """
    # Plain values only: the function travels to the workers without this package.
    width = params.rolling_window_seconds * 1_000_000
    few_bikes = params.critical_bikes_threshold
    fullness = params.critical_utilization_threshold

    def advance(
        key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        times, rates, empty, critical = state.get if state.exists else ([], [], False, False)
        times, rates = list(times), list(rates)
        rows = pd.concat(pieces).sort_values("micros")
        opened: list[list[str]] = []
        for at, bikes, rate in zip(
            rows["micros"], rows["bikes_available"], rows["utilization_rate"]
        ):
            kinds: list[str] = []
            if not times or at > times[-1]:
                times.append(int(at))
                rates.append(float(rate))
                while times[0] < at - width:
                    times.pop(0)
                    rates.pop(0)
                now_empty = bool(bikes == 0)
                now_critical = bool(
                    bikes <= few_bikes
                    and sum(rates) / len(rates) >= fullness
                )
                if now_empty and not empty:
                    kinds.append(EMPTY)
                if now_critical and not critical:
                    kinds.append(CRITICAL)
                empty, critical = now_empty, now_critical
            opened.append(kinds)
        state.update((times, rates, empty, critical))
        rows["kinds"] = opened
        yield rows.loc[rows["kinds"].map(len) > 0, _COLUMNS]

    opened = (
        facts.withColumn("micros", F.unix_micros("snapshot_timestamp"))
        .groupBy("station_key")
        .applyInPandasWithState(
            advance, _OUTPUT, _STATE, "append", GroupStateTimeout.NoTimeout
        )
    )
    return as_alerts(opened.withColumn("kind", F.explode("kinds")), F.col("kind"))
