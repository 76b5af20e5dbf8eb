"""Timestamp repair, parsing and display as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.params import DEFAULTS

# The text forms accepted after the engine's own ISO parse.
TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd HH:mm:ss",
)
# Fixed value: a numeric offset followed by a second, redundant zone letter.
DOUBLED_ZONE = r"([+-]\d{2}:?\d{2})Z$"

# Python's notion of surrounding whitespace, which is wider than SQL trim.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_MICROS = 1_000_000


def drop_doubled_zone(text: Column) -> Column:
    return F.regexp_replace(text, DOUBLED_ZONE, "$1")


def repair_timestamp_text(text: Column) -> Column:
    """Trimmed text without the redundant zone letter; null when blank."""
    trimmed = F.regexp_replace(text.cast("string"), _EDGE_SPACE, "")
    return drop_doubled_zone(F.nullif(trimmed, F.lit("")))


def parse_timestamp(text: Column) -> Column:
    """First accepted reading of the text, null when there is none (never raises)."""
    repaired = drop_doubled_zone(F.trim(text))
    return F.coalesce(
        F.try_to_timestamp(repaired),
        *[F.try_to_timestamp(repaired, F.lit(pattern)) for pattern in TIMESTAMP_PATTERNS],
    )


def time_bucket(instant: Column, seconds: int) -> Column:
    """Number of the fixed-width slice the instant lies in, counted from the epoch."""
    return micros_bucket(F.unix_micros(instant), seconds)


def micros_bucket(micros: Column, seconds: int) -> Column:
    width = F.lit(seconds * _MICROS)
    return F.call_function("div", micros - F.pmod(micros, width), width)


def bucket_date(bucket: Column, seconds: int) -> Column:
    return F.to_date(F.timestamp_seconds(bucket * F.lit(seconds)))


def seconds_before(instant: Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(instant) - F.lit(seconds * _MICROS))


def snapshot_token(instant: Column) -> Column:
    """ISO text with a numeric UTC offset; the fraction only when there is one."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fractional = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(instant) % _MICROS == 0, whole).otherwise(fractional)


def display_timestamp(instant: Column, zone: str = DEFAULTS.display_timezone) -> Column:
    """Local wall-clock text, or a dash when there is no instant."""
    local = F.from_utc_timestamp(instant.cast("timestamp"), zone)
    return F.coalesce(F.date_format(local, "dd/MM/yyyy HH:mm:ss"), F.lit("-"))


def hour_start(day: Column, hour: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(day.cast("timestamp")) + hour * F.lit(3600))


#: Seconds of the units of a watermark's text.
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 24 * 3600}


def interval_seconds(text: str) -> int:
    """Seconds of an interval such as '10 minutes' or '1 hour 30 minutes'."""
    parts = text.lower().split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {text!r}")
    pairs = zip(parts[::2], parts[1::2], strict=True)
    return sum(int(n) * _UNIT_SECONDS[unit.removesuffix("s")] for n, unit in pairs)
