"""Label aggregate and the user list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_table(df: DataFrame, *by: str) -> DataFrame:
    """Active days, watches and seconds watched per key.

    Two steps on purpose: the (key, day) step is a plain hash aggregation with map-side
    combine, so a user holding a large share of the rows shrinks to one row per day
    before the second step, and no row is copied for the distinct count.
    """
    keys = by or ("did",)
    daily = df.groupBy(*keys, "date_day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("vts").alias("seconds")
    )
    return daily.groupBy(*keys).agg(
        F.count("date_day").alias("active_days"),
        F.sum("rows").alias("watch_nums"),
        F.sum("seconds").alias("watch_durations"),
    )


def users(df: DataFrame) -> DataFrame:
    return df.select("did").distinct()
