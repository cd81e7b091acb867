"""The given tables seen as watch events and items.

``watch_*`` reads ``events`` with ``part`` as the item table; ``order_*`` reads
``lineitem`` with ``orders`` and has many items. Bounds on the event time are put as
literals on the stored column, so they reach the file scan.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY_SECONDS, naive_seconds

# fixed values: epoch seconds of the first possible release in each adapter
WATCH_RELEASE = 1698796800  # 2023-11-01
ORDER_RELEASE = 770428800  # 1994-06-01


def _parts(spark: SparkSession, sf_dir: str, release: int) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    online: Column = F.timestamp_seconds(F.lit(release) + F.col("p_size") * F.lit(DAY_SECONDS))
    return part.select(
        F.col("p_partkey").alias("vid"),
        F.col("p_brand").alias("cid"),
        (F.col("p_size") % 9 + 1).alias("is_intact"),
        online.alias("online_time"),
        F.col("p_name").alias("series_id"),
        (F.col("p_size") * 10.0).alias("duration"),
        F.col("p_type").alias("classify_id"),
    )


def _within(df: DataFrame, column: str, bounds: tuple[int, int] | None) -> DataFrame:
    """Rows whose stored time lies between two epoch seconds, both kept."""
    if bounds is None:
        return df
    kind = df.schema[column].dataType.simpleString()
    low, high = (max(-62135596800, min(253402300799, b)) for b in bounds)
    text = [datetime.datetime.fromtimestamp(b, datetime.UTC).strftime("%Y-%m-%d %H:%M:%S") for b in (low, high + 1)]
    first, after = (F.lit(t).cast("timestamp_ntz").cast(kind) for t in text)
    # a whole second at the upper end: stored times may hold fractions; a date is compared as its midnight
    return df.where((F.col(column) >= first) & ((F.col(column) <= after) if kind == "date" else (F.col(column) < after)))


def watch_events(spark: SparkSession, sf_dir: str, bounds: tuple[int, int] | None = None) -> DataFrame:
    events = _within(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", bounds)
    return events.select(
        F.col("user_id").alias("did"),
        F.get_json_object("props", "$.k").cast("long").alias("vid"),
        F.col("value").alias("vts"),
        naive_seconds(F.col("ts")).alias("timestamp"),
    )


def watch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, WATCH_RELEASE)


def order_events(spark: SparkSession, sf_dir: str, bounds: tuple[int, int] | None = None) -> DataFrame:
    line = _within(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_shipdate", bounds)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("did"),
        F.col("l_partkey").alias("vid"),
        F.col("l_quantity").alias("vts"),
        naive_seconds(F.col("l_shipdate")).alias("timestamp"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, ORDER_RELEASE)
