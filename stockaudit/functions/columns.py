"""Column expressions: contacts, masking, formats, workday arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockaudit.functions.parameters import DAY_END_HOUR, DAY_START_HOUR, PHONE_PATTERN


def contact_email(name: Column) -> Column:
    """info@<name, lower case, without spaces and dots, at most 20 characters>.com.eg"""
    return F.concat(F.lit("info@"), F.substring(F.translate(F.lower(name), " .", ""), 1, 20), F.lit(".com.eg"))


def mask_secret(text: Column, field: str = "PWD") -> Column:
    """Hide the value after ``field=`` up to the next semicolon."""
    return F.regexp_replace(text, f"{field}=[^;]+", f"{field}=***")


def is_phone(text: Column, pattern: str = PHONE_PATTERN) -> Column:
    return text.rlike(pattern)


def is_off_hours(ts: Column, start: int = DAY_START_HOUR, end: int = DAY_END_HOUR) -> Column:
    return (F.hour(ts) < start) | (F.hour(ts) >= end)


def at_hour(day: Column, hour: int) -> Column:
    """``hour`` o'clock on a date, as a zone-less timestamp."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour))


def hour_start(ts: Column) -> Column:
    """The full hour of a zone-less timestamp."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def next_workday_start(ts: Column, start: int = DAY_START_HOUR) -> Column:
    """Start of work on the following calendar day, whatever the hour."""
    return at_hour(F.date_add(F.to_date(ts), 1), start)


def day_end(ts: Column, end: int = DAY_END_HOUR) -> Column:
    """The first closing time at or after ``ts``."""
    today = at_hour(F.to_date(ts), end)
    return F.when(ts <= today, today).otherwise(at_hour(F.date_add(F.to_date(ts), 1), end))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes elapsed, rounded down."""
    return F.timestamp_diff("MINUTE", start, end)
