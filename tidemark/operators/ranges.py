"""Closed ranges over calendar days and instants."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import LOCAL_ZONE, local_day


def _day(end: date | Column) -> Column:
    return F.lit(end) if isinstance(end, date) else end


def day_range(df: DataFrame, end: date | Column, day: int) -> DataFrame:
    """Rows with ``end - day <= date_day <= end``: ``day + 1`` local days."""
    end = _day(end)
    return df.where(F.col("date_day").between(F.date_sub(end, day), end))


def lookback(df: DataFrame, anchor: date | Column, days: int) -> DataFrame:
    """Exactly ``days`` local days, the anchor's day being the last."""
    return df.where(F.datediff(_day(anchor), F.col("date_day")).between(0, days - 1))


def instant_range(df: DataFrame, end_seconds: int | Column, day: int, zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows within ``day`` times 24 hours before ``end_seconds``, both ends kept.

    Rows that have their local day are chosen by it, too: where they are stored by day, other days
    are not read.
    """
    end = F.lit(end_seconds) if isinstance(end_seconds, int) else end_seconds
    first = end - F.lit(day * 86400)
    if "date_day" in df.columns:
        df = df.where(F.col("date_day").between(local_day(first, zone), local_day(end, zone)))
    return df.where(F.col("timestamp").between(first, end))


def window_bounds(df: DataFrame, *by: str) -> DataFrame:
    """First and last instant and the row count, per ``by`` or overall."""
    return df.groupBy(*by).agg(
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.count(F.lit(1)).alias("rows"),
    )
