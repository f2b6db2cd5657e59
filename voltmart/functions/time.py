"""Time arithmetic on microseconds, independent of interval parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: Column, b: Column | int) -> Column:
    """Integral division, cut toward zero (``bigint`` or ``decimal`` operands)."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def as_ts(value: Column | str) -> Column:
    """A timestamp parameter: a column, or an ISO text literal read in the session zone."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    n = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(col(ts)) + n.cast("bigint") * F.lit(MICROS))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(col(end)) - F.unix_micros(col(start))


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end, cut toward zero like an integer conversion."""
    return div(micros_between(start, end), MICROS)


def floor_to(ts: Column | str, step_s: int) -> Column:
    """Start of the step that holds ``ts``; steps are counted from the epoch."""
    micros = F.unix_micros(col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step_s * MICROS)))
