"""Column helpers shared by the routes. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(text: Column) -> Column:
    """Text to bigint; NULL for absent or unreadable input."""
    return text.try_cast("bigint")


def bad_number(text: Column) -> Column:
    """True when a number is present but does not read as a bigint."""
    return text.isNotNull() & whole(text).isNull()


def message_json(*columns: Column) -> Column:
    """Record to JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def event_day(ts_ms: Column, tz: str = "UTC") -> Column:
    """Date of epoch milliseconds in ``tz``, whatever the session time zone."""
    return _wall_clock(ts_ms, tz).cast("date")


def event_date(ts_ms: Column, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd`` of epoch milliseconds in ``tz``."""
    return event_day(ts_ms, tz).cast("string")


def event_hour(ts_ms: Column, tz: str = "UTC") -> Column:
    """Two-digit hour of epoch milliseconds in ``tz``."""
    return F.lpad(F.hour(_wall_clock(ts_ms, tz)).cast("string"), 2, "0")


def _wall_clock(ts_ms: Column, tz: str) -> Column:
    local = F.timestamp_millis(ts_ms).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(tz), local)


def create_date(create_time: Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(create_time, 1, 10)


def create_hour(create_time: Column) -> Column:
    """Hour part of ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(create_time, 12, 2)
