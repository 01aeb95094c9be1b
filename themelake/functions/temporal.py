"""Instants, labels and local calendar days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def instant(c: Column | str) -> Column:
    """ISO text to a UTC instant; unreadable text is missing."""
    return _col(c).try_cast("timestamp")


def month_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def day_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def local_date(epoch_seconds: Column | str, zone: str) -> Column:
    """Calendar day in ``zone`` of an epoch second, whatever the session zone."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=_col(epoch_seconds).cast("decimal(18,6)")
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")
