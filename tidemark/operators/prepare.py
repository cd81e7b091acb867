"""Events with local time, item columns and row-level measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import (
    LOCAL_ZONE, iso_weekday, local_day, local_hour, local_minute, to_instant,
)
from tidemark.functions.measures import item_age_days, ratio
from tidemark.operators.joins import Heavy, lookup_join
from tidemark.sources.schema import ITEM_COLUMNS

ITEM_ROW_BYTES = 256


def localize(events: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Event instant and local calendar day."""
    return events.withColumns({
        "date": to_instant(F.col("timestamp")),
        "date_day": local_day(F.col("timestamp"), zone),
    })


def calendar_parts(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Weekday, hour and minute-in-ten of the local wall clock."""
    at = F.col("timestamp")
    return df.withColumns({
        "date_weekday": iso_weekday(F.col("date_day")),
        "date_hour": local_hour(at, zone),
        "date_minute": local_minute(at, zone) % 10,
    })


def unique_items(items: DataFrame) -> DataFrame:
    """One row per video: the smallest whole row, chosen by a combinable aggregate."""
    rest = [c for c in items.columns if c != "vid"]
    return (
        items.groupBy("vid").agg(F.min(F.struct(*rest)).alias("_row")).select("vid", "_row.*")
    )


def repeated_items(items: DataFrame) -> DataFrame:
    """Videos listed more than once: these would multiply their events in the join."""
    return items.groupBy("vid").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def attach_items(
    events: DataFrame, items: DataFrame, item_rows: int, heavy: Heavy = Heavy()
) -> DataFrame:
    """Left join to the item table, once, ahead of all windows."""
    kept = items.select(*[c for c in ITEM_COLUMNS if c in items.columns])
    return lookup_join(
        events, kept, ["vid"],
        right_rows=item_rows, row_bytes=ITEM_ROW_BYTES, heavy=heavy, spread_on=["did", "timestamp"],
    )


def add_measures(df: DataFrame, compat: bool = False) -> DataFrame:
    """Item age and the watch ratios.

    The weekday ratio divides by the weekday; ``compat`` divides by the item age, as the
    first version of this feature did.
    """
    aged = df.withColumn("u_date", item_age_days(F.col("timestamp"), F.col("online_time")))
    by_day = F.col("u_date") if compat else iso_weekday(F.col("date_day"))
    return aged.withColumns({
        "date_weekday": iso_weekday(F.col("date_day")),
        "vts/duration": ratio(F.col("vts"), F.col("duration")),
        "vts/u_date": ratio(F.col("vts"), F.col("u_date")),
        "vts/date_weekday": ratio(F.col("vts"), by_day),
    })


def prepare(
    events: DataFrame,
    items: DataFrame,
    item_rows: int,
    heavy: Heavy = Heavy(),
    zone: str = LOCAL_ZONE,
    dedupe_items: bool = True,
    compat: bool = False,
) -> DataFrame:
    """Events with item columns and measures.

    A video listed twice would count its watches twice, so items are made unique first; a
    caller that has checked (``repeated_items``) may leave that out.
    """
    items = unique_items(items) if dedupe_items else items
    joined = attach_items(localize(events, zone), items, item_rows, heavy)
    return add_measures(joined, compat).drop("online_time", "duration")
