"""Dates, clock minutes and freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def usable_offset(offset: Column, other: Column | None = None) -> Column:
    """The offset if it can be one (up to 18 hours), else ``other``, else 0."""
    return F.coalesce(F.when(F.abs(offset) <= 64800, offset), *([] if other is None else [other]), F.lit(0)).cast("bigint")


def local_date(seconds: Column, offset: Column, local_seconds: Column | None = None) -> Column:
    """Date of the local clock: of the local epoch where known, else of the instant plus its offset; null outside years 1 to 9999."""
    at = seconds + F.coalesce(offset, F.lit(0)).cast("bigint")
    at = at if local_seconds is None else F.coalesce(local_seconds, at)
    return F.to_date(F.timestamp_seconds(F.when(at.between(-62135596800, 253402300799), at)))


def date_at(instant: Column, *, zone: Column | None = None, offset: Column | None = None) -> Column:
    """Date of an instant (timestamp) in a named zone, else at an offset in seconds; an error where a row has neither."""
    zoned = F.to_date(F.from_utc_timestamp(instant, zone)) if zone is not None else F.lit(None).cast("date")
    shifted = F.to_date(F.timestamp_micros(F.unix_micros(instant) + offset.cast("bigint") * 1_000_000)) if offset is not None else F.lit(None).cast("date")
    date = F.coalesce(zoned, shifted)
    return F.when(instant.isNull(), F.lit(None).cast("date")).when(date.isNull(), F.raise_error(F.lit("neither a zone nor an offset")).cast("date")).otherwise(date)


def sleep_date(end_seconds: Column, offset: Column) -> Column:
    """Local date of the last microsecond before the end: a night that ends at midnight belongs to the day before."""
    return F.to_date(F.timestamp_seconds(end_seconds - 1 + offset))


def clock_minute(seconds: Column, offset: Column) -> Column:
    """Minute of the local day, 0 to 1439, also before 1970."""
    return F.pmod(F.floor((seconds + offset) / 60), F.lit(1440))


def freshness(date: Column, requested: Column, last_end: Column, as_of: Column, current: Column, max_hours: int = 36) -> Column:
    """MISSING (no date), HISTORICAL (not the requested date), STALE (not current, ended in the future or too long ago), FRESH.

    ``as_of`` is a parameter, never the wall clock; instants are in seconds.
    """
    return (
        F.when(date.isNull(), "MISSING")
        .when(date != requested, "HISTORICAL")
        .when(~F.coalesce(current, F.lit(False)) | last_end.isNull() | (last_end > as_of) | (as_of - last_end > max_hours * 3600), "STALE")
        .otherwise("FRESH")
    )
