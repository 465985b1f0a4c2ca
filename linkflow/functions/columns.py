"""Column expressions shared by the operators (all Spark built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 text layout of instants written by the producer and
# the landing consumer (microseconds, numeric offset).
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tcast(c: str | Column, to: str) -> Column:
    """``CAST`` that yields NULL instead of failing (ANSI-safe)."""
    return col(c).try_cast(to)


def to_ts(c: str | Column) -> Column:
    """Text (ISO-8601, optional offset) -> TIMESTAMP; bad text -> NULL."""
    return col(c).try_cast("timestamp")


def to_ntz(c: str | Column) -> Column:
    """Instant -> TIMESTAMP_NTZ holding its UTC wall clock (session is UTC)."""
    return col(c).cast("timestamp_ntz")


def iso_text(c: str | Column) -> Column:
    """Instant -> ISO-8601 text with microseconds and numeric offset."""
    return F.date_format(col(c), ISO_FORMAT)


def epoch_seconds(c: str | Column) -> Column:
    """Whole seconds since the epoch, floored (``unix_timestamp`` of a ts)."""
    return F.unix_timestamp(col(c))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Fractional seconds ``later - earlier`` with microsecond precision."""
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / F.lit(1_000_000.0)


def round6(c: str | Column) -> Column:
    """Averages are published rounded to 6 decimals (stable across engines)."""
    return F.round(col(c), 6)


def hour_local_bucket(c: str | Column, minutes: int) -> Column:
    """Floor an instant to ``minutes``-wide buckets counted from the top of
    its UTC hour (the bucket restarts every hour, unlike ``window``)."""
    c = col(c)
    m = F.floor(F.minute(c) / F.lit(minutes)) * F.lit(minutes)
    return F.date_trunc("hour", c) + F.make_interval(mins=m.cast("int"))


def epoch_bucket(c: str | Column, minutes: int) -> Column:
    """Floor an instant to ``minutes``-wide buckets aligned to the epoch."""
    return F.window(col(c), f"{minutes} minutes").start


def null_safe_div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))
