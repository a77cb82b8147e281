"""Time expressions that do not depend on the session time zone.

The driver tables store wall-clock ``TIMESTAMP_NTZ``. Converting through the
session zone would make results depend on cluster settings, so epoch values
are built from the calendar date and the time of day, which is exact and
zone free, and stays inside codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def seconds(duration: str | int | float) -> int:
    """Parse a duration such as ``3m``, ``2h``, ``90s``, ``1h30m`` (or a number of seconds)."""
    if isinstance(duration, (int, float)):
        return int(duration)
    text = duration.strip().lower().replace(" ", "")
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h|d|w)", text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"bad duration: {duration!r}")
    total = sum(float(n) * _UNITS[u] for n, u in parts)
    if total != int(total):
        raise ValueError(f"duration must be whole seconds: {duration!r}")
    return int(total)


def interval_text(duration: str | int) -> str:
    """Duration in the form ``window()`` and ``withWatermark`` accept."""
    return f"{seconds(duration)} seconds"


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock NTZ timestamp.

    Built from the calendar date and the time of day, which are read from an
    NTZ value without any zone (``timestampdiff`` would cast through the
    session zone and be off by DST shifts outside UTC).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(c.cast("date")).cast("bigint")
    secs = F.hour(c).cast("bigint") * 3600 + F.minute(c).cast("bigint") * 60
    micros = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint")
    return days * F.lit(86_400_000_000) + secs * F.lit(1_000_000) + micros


def from_epoch_micros(us: Column | str) -> Column:
    """NTZ timestamp from microseconds since the epoch (inverse of :func:`epoch_micros`)."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, F.expr(_NTZ_EPOCH))


def epoch_millis(ts: Column | str) -> Column:
    """Whole milliseconds since the epoch (floor, integer arithmetic)."""
    us = epoch_micros(ts)
    # the quotient is an exact integer below 2^53, so the double division is exact
    return ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("bigint")


def as_instant(ts: Column | str) -> Column:
    """NTZ wall clock read as UTC -> ``TIMESTAMP`` (needed by ``withWatermark``)."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts: Column | str) -> Column:
    """``TIMESTAMP`` -> NTZ wall clock in UTC, zone free (inverse of :func:`as_instant`)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return from_epoch_micros(F.unix_micros(c))


def ntz_literal(text: str) -> Column:
    """A wall-clock timestamp literal, independent of the session zone."""
    return F.to_timestamp_ntz(F.lit(text))


def iso_millis_utc(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS+00:00`` of a wall-clock UTC NTZ timestamp,
    built from its calendar parts (``date_format`` would go through the
    session zone and shift times that fall in a DST gap there)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    ms = F.floor(F.extract(F.lit("SECOND"), c) * F.lit(1000)).cast("int")

    def two(x: Column, n: int = 2) -> Column:
        return F.lpad(x.cast("string"), n, "0")
    return F.concat(c.cast("date").cast("string"), F.lit("T"), two(F.hour(c)), F.lit(":"), two(F.minute(c)),
                    F.lit(":"), two((ms / 1000).cast("int")), F.lit("."), two(ms % 1000, 3), F.lit("+00:00"))


def year_month_text(ts: Column | str) -> Column:
    """``yyyy-MM`` of a date or NTZ timestamp: the first seven characters of its
    calendar date as text (a date cast, no session zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.substring(c.cast("date").cast("string"), 1, 7)
