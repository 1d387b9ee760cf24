"""Time values as 64-bit nanoseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS_PER_SECOND = 1_000_000_000


def _wall_clock_micros(column: Column) -> Column:
    # A zone-less timestamp must not pass through the session time zone.
    midnight = F.unix_date(column.cast("date")).cast("long") * F.lit(86_400_000_000)
    seconds = F.hour(column) * F.lit(3600) + F.minute(column) * F.lit(60)
    fraction = (F.extract(F.lit("SECOND"), column) * F.lit(1_000_000)).cast("long")
    return midnight + seconds.cast("long") * F.lit(1_000_000) + fraction


def normalize_times(df: DataFrame, name: str, *, strict_ns: bool = False) -> Column:
    """Column ``name`` of ``df`` as nanoseconds, by its type.

    Integers pass unchanged (nanoseconds or a sequence), floats are seconds and are
    truncated. Timestamps and intervals hold microseconds in Spark and are widened,
    which is exact; ``strict_ns`` refuses them instead. A time beyond 64 bits of
    nanoseconds (after the year 2262) is null, as a row without a time.
    """
    column = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column.cast("double") * F.lit(float(NANOS_PER_SECOND))).try_cast("long")
    if strict_ns:
        raise ValueError(f"column {name!r} of type {kind.simpleString()} has less than nanosecond resolution")
    if isinstance(kind, T.TimestampNTZType):
        return F.try_multiply(_wall_clock_micros(column), F.lit(1000))
    if isinstance(kind, T.TimestampType):
        return F.try_multiply(F.unix_micros(column), F.lit(1000))
    if isinstance(kind, T.DayTimeIntervalType):
        whole = F.extract(F.lit("DAY"), column).cast("long") * F.lit(86_400)
        whole = whole + F.extract(F.lit("HOUR"), column).cast("long") * F.lit(3600)
        whole = whole + F.extract(F.lit("MINUTE"), column).cast("long") * F.lit(60)
        fraction = (F.extract(F.lit("SECOND"), column) * F.lit(NANOS_PER_SECOND)).cast("long")
        return F.try_add(F.try_multiply(whole, F.lit(NANOS_PER_SECOND)), fraction)
    raise ValueError(f"column {name!r} of type {kind.simpleString()} is not a time")


def elapsed_seconds(time_ns: Column, start_ns: Column) -> Column:
    """Seconds since the start, single precision."""
    return ((time_ns - start_ns) / F.lit(float(NANOS_PER_SECOND))).cast("float")


def nominal_seconds(frame_index: Column, fps: int) -> Column:
    """Time of a frame when frames are taken as evenly spaced."""
    return (frame_index / F.lit(float(fps))).cast("float")


def grid_step_ns(fps: int) -> int:
    return int(NANOS_PER_SECOND / fps)


def grid_size_ns(start: Column, stop: Column, fps: int) -> Column:
    """Number of points of the half-open grid [start, stop); one point when it is empty."""
    step = F.lit(grid_step_ns(fps)).cast("long")
    span = F.greatest(stop - start, F.lit(1).cast("long")) - F.lit(1)
    return F.call_function("div", span, step) + F.lit(1)


def grid_size_seconds(start: Column, stop: Column, fps: int) -> Column:
    """Number of points of the same grid in float seconds."""
    return F.greatest(F.ceil((stop - start) * F.lit(float(fps))), F.lit(1).cast("long"))
