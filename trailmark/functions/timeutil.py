"""Times and durations as BIGINT microseconds."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seconds_part(us: Column | str) -> Column:
    """Whole seconds, rounded down also below zero."""
    return ((_c(us) - F.pmod(_c(us), F.lit(1_000_000))) / 1_000_000).cast("long")


def nanoseconds_part(us: Column | str) -> Column:
    return F.pmod(_c(us), F.lit(1_000_000)) * 1000


def time_struct(us: Column | str) -> Column:
    """(sec, nanosec) of a time or signed duration; -0.5 s is (-1, 500000000)."""
    return F.struct(seconds_part(us).alias("sec"), nanoseconds_part(us).alias("nanosec"))


def to_microseconds(sec: Column | str, nanosec: Column | str) -> Column:
    """Microseconds; what is finer is cut off."""
    return _c(sec) * 1_000_000 + F.floor(_c(nanosec) / 1000)


def from_seconds(seconds: Column | str) -> Column:
    """Seconds as DOUBLE in microseconds, ties to even."""
    return F.rint(_c(seconds) * 1_000_000).cast("long")


def nanoseconds_from_seconds(seconds: Column | str) -> Column:
    return F.rint(_c(seconds) * 1_000_000_000).cast("long")


def history_capacity(history_s: float, period_s: float, most: int) -> int:
    """Samples that a track's ring holds."""
    return max(1, min(math.floor(history_s / period_s) + 1, most))
