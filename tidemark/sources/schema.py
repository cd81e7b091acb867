"""Declared schemas: no inference pass, and no types that depend on the data."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "did"
LABELS = ("active_days", "watch_nums", "watch_durations")

BEHAVIORS = T.StructType([
    T.StructField("did", T.StringType()),
    T.StructField("vid", T.StringType()),
    T.StructField("vts", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

# as stored: online_time is text without a zone
ITEMS_TEXT = T.StructType([
    T.StructField("vid", T.StringType()),
    T.StructField("cid", T.StringType()),
    T.StructField("is_intact", T.IntegerType()),
    T.StructField("online_time", T.StringType()),
    T.StructField("serialno", T.IntegerType()),
    T.StructField("series_id", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("stars", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("img_url", T.StringType()),
    T.StructField("classify_id", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("did", T.StringType()),
    T.StructField("active_days", T.DoubleType()),
    T.StructField("watch_nums", T.DoubleType()),
    T.StructField("watch_durations", T.DoubleType()),
])

# item columns any feature reads; stars, tags, img_url and serialno never are
ITEM_COLUMNS = ("vid", "cid", "is_intact", "online_time", "series_id", "duration", "classify_id")
