"""Event-time columns. All of them assume a UTC session."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, functions as F

from crowdtide.fixed_values import UNKNOWN_DAY

DAY_MICROS = 24 * 60 * 60 * 1_000_000
_UNIT_MICROS = {
    "ms": 1_000,
    "s": 1_000_000,
    "sec": 1_000_000,
    "m": 60_000_000,
    "min": 60_000_000,
    "t": 60_000_000,
    "h": 3_600_000_000,
    "d": DAY_MICROS,
}


def parse_time(value: Column) -> Column:
    """A timestamp, or NULL. A bare number of 9 to 15 digits means milliseconds."""
    text = value.cast("string")
    millis = F.when(text.rlike(r"^-?\d{9,15}$"), F.timestamp_millis(text.try_cast("bigint")))
    return F.coalesce(F.try_to_timestamp(text), millis)


def time_or_now(ts: Column, now: datetime | Column | None = None) -> Column:
    """Missing times become the processing time, which a caller may fix."""
    if now is None:
        now = F.current_timestamp()
    return F.coalesce(ts, now if isinstance(now, Column) else F.lit(now).cast("timestamp"))


def window_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def post_iso(ts: Column) -> Column:
    """ISO form with offset; the fraction is shown, in six digits, only if there is one."""
    whole = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def event_day(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(UNKNOWN_DAY))


def frequency_micros(frequency: str) -> int:
    """``"5min"``, ``"1h"``, ``"15m"``, ``"1D"`` as microseconds."""
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", frequency)
    if not match or match[2].lower() not in _UNIT_MICROS or match[1].strip("0") == "" and match[1]:
        raise ValueError(f"not a fixed window length: {frequency!r}")
    return int(match[1] or 1) * _UNIT_MICROS[match[2].lower()]


def window_floor(ts: Column, length_micros: int, origin_micros: Column | int = 0) -> Column:
    """Start of the left-closed window of that length, counted from the origin."""
    micros = F.unix_micros(ts)
    origin = origin_micros if isinstance(origin_micros, Column) else F.lit(origin_micros)
    return F.timestamp_micros(micros - F.pmod(micros - origin, F.lit(length_micros)))
