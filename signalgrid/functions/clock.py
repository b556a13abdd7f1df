"""Local wall-clock time without dependence on the session zone.

All stored times are ``timestamp_ntz`` in the network's own zone, or a date plus an hour.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from signalgrid.settings import LOCAL_ZONE

# The last millisecond of 2099; micro- and nanoseconds of our time lie beyond it.
LAST_EPOCH_MS = 4_102_444_799_999


def local_time(epoch_ms: Column, zone: str = LOCAL_ZONE) -> Column:
    """Epoch milliseconds to local time, cut to whole seconds; null for what cannot be
    milliseconds since 1970."""
    zero = F.lit(0)
    known = F.when(epoch_ms.between(0, LAST_EPOCH_MS), epoch_ms)
    seconds = F.floor(known / 1000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(zero, zero, zero, seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def record_time(date: Column, hour: Column) -> Column:
    """The start of an hour as a local timestamp."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def iso_weekday(date: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return (F.weekday(date) + 1).cast("int")


def hour_label(hour: Column) -> Column:
    """``7`` as ``'07:00'``."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
