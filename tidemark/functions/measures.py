"""Row-level measures: item age, watch ratios, recency weight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY_SECONDS, release_seconds

DECAY = 0.95


def item_age_days(timestamp: Column, online_time: Column) -> Column:
    return (timestamp - release_seconds(online_time)) / F.lit(float(DAY_SECONDS))


def ratio(value: Column, divisor: Column) -> Column:
    """NULL where the divisor is zero: an infinity would poison every mean."""
    return F.try_divide(value, divisor)


def decay_weight(age_from_one: Column, base: float = DECAY) -> Column:
    return F.pow(F.lit(base), age_from_one)
