"""Time columns: epoch milliseconds, calendar parts, report bounds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, truncated to whole seconds."""
    return F.timestamp_seconds(F.floor(ms / F.lit(1000)))


def epoch_ms_to_text(ms: Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(epoch_ms_to_time(ms), "yyyy-MM-dd HH:mm:ss")


def time_to_epoch_ms(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def lake_date_parts(time: Column) -> dict[str, Column]:
    """Zero-padded ``year``, ``month``, ``day`` as the lake paths spell them."""
    return {
        "year": F.date_format(time, "yyyy"),
        "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd"),
    }


def text_date_parts(text: Column) -> dict[str, Column]:
    """The same parts cut from ``yyyy-MM-dd HH:mm:ss`` text."""
    parts = F.split(F.split(text, " ")[0], "-")
    return {"year": parts[0], "month": parts[1], "day": parts[2]}


def previous_day(as_of: Column) -> Column:
    """The same second one day earlier."""
    return F.date_trunc("second", as_of) - F.expr("INTERVAL 1 DAY")


def report_bounds(as_of: datetime) -> tuple[datetime, datetime]:
    """Inclusive ``(previous, current)`` bounds of a daily report."""
    current = as_of.replace(microsecond=0)
    return current - timedelta(days=1), current


def utc_literal(moment: datetime) -> Column:
    """A UTC timestamp literal, whatever the zone of the driver or the session."""
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S}Z").cast("timestamp")


def between_times(time: Column, low: datetime, high: datetime) -> Column:
    """Inclusive range on a timestamp column."""
    return time.between(utc_literal(low), utc_literal(high))
