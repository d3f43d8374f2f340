"""Calendar parts, truncation, differences and latencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = 0


def date_key(moment: Column) -> Column:
    """yyyymmdd as a number; 0 for NULL."""
    number = F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)
    return F.coalesce(number, F.lit(UNKNOWN_DATE_KEY)).cast("long")


def month_of(moment: Column) -> Column:
    return F.trunc(moment, "MM")


def minute_of(moment: Column) -> Column:
    return F.date_trunc("minute", moment)


def year_label(moment: Column) -> Column:
    return F.year(moment).cast("string")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(end, start)


def _elapsed_micros(start: Column, end: Column) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def elapsed_ms(start: Column, end: Column) -> Column:
    return _elapsed_micros(start, end) / F.lit(1e3)


def elapsed_seconds(start: Column, end: Column) -> Column:
    return _elapsed_micros(start, end) / F.lit(1e6)


def in_range(moment: Column, start=None, end=None) -> Column:
    """Time-range filter of a report; an open end does not filter."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (moment >= F.lit(start).cast("timestamp"))
    if end is not None:
        condition = condition & (moment <= F.lit(end).cast("timestamp"))
    return condition


def calendar_days(rows: DataFrame, *date_columns: str, margin_days: int = 365) -> DataFrame:
    """One row per day from the earliest to the latest date of the columns, with a margin on both sides.

    Column minima and maxima combine map-side, so only one row per task is shuffled and no row
    is exploded; the spine itself is generated from that single row.
    """
    earliest = F.least(*[F.min(c) for c in date_columns]) if len(date_columns) > 1 else F.min(date_columns[0])
    latest = F.greatest(*[F.max(c) for c in date_columns]) if len(date_columns) > 1 else F.max(date_columns[0])
    bounds = rows.agg(
        F.date_sub(earliest.cast("date"), margin_days).alias("first_day"),
        F.date_add(latest.cast("date"), margin_days).alias("last_day"),
    ).where("first_day IS NOT NULL")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))


def calendar_columns(day: Column) -> list[Column]:
    """Calendar attributes of a day; weeks start on Sunday = 1."""
    weekday = F.dayofweek(day)
    # The columns of the date table, their names and order.
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date_alternate_key"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).cast("short").alias("calendar_season"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("season_name"),
        F.month(day).cast("short").alias("month_number_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("short").alias("day_number_of_month"),
        weekday.cast("short").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        weekday.isin(1, 7).cast("short").alias("is_weekend"),
    ]
