"""Date and time expressions over ISO text or timestamp columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_timestamp(value: Column | str) -> Column:
    """Timestamp of ISO text (or of a timestamp column); null where the text is not one."""
    return _column(value).try_cast("timestamp")


def order_date(value: Column | str) -> Column:
    """Calendar date of ISO text; null where the text is not a date."""
    return _column(value).try_cast("date")


def hour_of(value: Column | str) -> Column:
    """Hour of day, 0 to 23."""
    return F.hour(as_timestamp(value))


def day_of_week(value: Column | str) -> Column:
    """Weekday number, 1 = Sunday to 7 = Saturday."""
    return F.dayofweek(_column(value))


def day_name(value: Column | str) -> Column:
    """English weekday name (Spark formats with the US locale whatever the machine's)."""
    return F.date_format(_column(value), "EEEE")


def midnight(value: Column | str) -> Column:
    """Timestamp at the start of a date."""
    return _column(value).cast("timestamp")


def iso_date(value: Column | str) -> Column:
    """Date as ``yyyy-MM-dd`` text."""
    return F.date_format(_column(value), "yyyy-MM-dd")


def iso_text(value: Column | str) -> Column:
    """Timestamp as ISO text with microseconds, the fraction left out where it is zero."""
    text = F.date_format(_column(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.endswith(text, F.lit(".000000")), F.left(text, F.lit(19))).otherwise(text)
