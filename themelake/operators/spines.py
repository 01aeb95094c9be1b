"""Calendar spines and time-axis expansion."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import local_date


def month_spine(first_year: int, last_year: int) -> Column:
    """First day of every month, the whole last year included, as an array."""
    return F.sequence(
        F.lit(date(first_year, 1, 1)), F.lit(date(last_year, 12, 1)), F.make_ym_interval(months=F.lit(1))
    )


def trailing_days(today: date | Column, n: int = 7) -> Column:
    """The ``n`` days before ``today``, which is left out, as an array."""
    end = F.lit(today) if isinstance(today, date) else today
    return F.sequence(F.date_sub(end, n), F.date_sub(end, 1))


def window_bounds(today: date, days_back: int) -> tuple[str, str]:
    """ISO days (today, start)."""
    return today.isoformat(), (today - timedelta(days=days_back)).isoformat()


def expand_daily(
    df: DataFrame,
    arrays: list[str],
    zone: str,
    start: str = "start",
    end: str = "end",
    step: str = "interval",
    out: str = "date",
) -> DataFrame:
    """One row per local day of parallel arrays on a regular axis.

    The axis runs from ``start`` up to and without ``end``; the shortest array
    cuts it. With steps of whole days, days count up from the local start day, so
    a clock change neither repeats nor skips one; with other steps each instant
    has its own local day.
    """
    axis = F.ceil((F.col(end) - F.col(start)) / F.col(step)).cast("int")
    length = F.greatest(F.lit(0), F.least(axis, *[F.size(a) for a in arrays]))
    others = [c for c in df.columns if c not in {*arrays, start, end, step}]
    rows = df.select(
        *others,
        local_date(F.col(start), zone).alias("_day"),
        F.col(start).alias("_start"),
        F.col(step).alias("_step"),
        F.posexplode(F.slice(F.arrays_zip(*arrays), F.lit(1), length)).alias("_pos", "_values"),
    )
    passed = F.call_function("div", F.col("_pos") * F.col("_step"), F.lit(86400)).cast("int")
    return rows.select(
        *others,
        F.when(F.col("_step") % 86400 == 0, F.date_add("_day", passed))
        .otherwise(local_date(F.col("_start") + F.col("_pos") * F.col("_step"), zone)).alias(out),
        *[F.col(f"_values.{a}").alias(a) for a in arrays],
    )
