"""Look-back windows that end at anchors of a table, each user having any number of own ones.

Events and anchors meet by user and bucket of days: an anchor's window covers few buckets, an event
lies in one, so the join is by equal keys and looks at no event far from a window. The exact
bounds are checked on what meets. Heavy users' events are spread over salts, their anchors repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day_number
from tidemark.operators.joins import Heavy, spread_keys

ANCHOR = ("did", "anchor", "days")


def anchored_events(events: DataFrame, anchors: DataFrame, heavy: Heavy = Heavy(), width: int = 16) -> DataFrame:
    """Each event once for every anchor (did, anchor, days) whose ``days`` local days up to ``anchor`` hold it.

    Adds anchor, days and ``age`` (0 on the anchor's day). A missing user, anchor, length or event
    day meets nothing; repeated anchors meet the events once.
    """
    wanted = anchors.select(*ANCHOR).distinct().where("did IS NOT NULL AND anchor IS NOT NULL AND days > 0")
    last = F.floor(day_number(F.col("anchor")) / F.lit(width))
    first = F.floor((day_number(F.col("anchor")) - F.col("days") + 1) / F.lit(width))
    wanted = wanted.withColumn("_bucket", F.explode(F.sequence(first, last)))
    rows = events.where("did IS NOT NULL AND date_day IS NOT NULL")
    rows = rows.withColumn("_bucket", F.floor(day_number(F.col("date_day")) / F.lit(width)))
    rows, wanted = spread_keys(rows, wanted, "did", heavy, [c for c in events.columns if c != "did"])
    age = F.datediff(F.col("anchor"), F.col("date_day"))
    met = rows.join(wanted, ["did", "_bucket", "_salt"]).withColumn("age", age)
    return met.where(F.col("age").between(0, F.col("days") - 1)).drop("_bucket", "_salt")


def anchor_activity(events: DataFrame, anchors: DataFrame, heavy: Heavy = Heavy(), width: int = 16) -> DataFrame:
    """One row per anchor: active days, watches, videos and seconds of its window; none where it is empty.

    Rows first become days (and days and videos) of an anchor, combined before they are shuffled.
    """
    met = anchored_events(events, anchors, heavy, width)
    pairs = met.groupBy(*ANCHOR, "date_day", "vid").agg(F.count(F.lit(1)).alias("n"), F.sum("vts").alias("s"))
    days = pairs.groupBy(*ANCHOR, "date_day").agg(F.sum("n").alias("watch_nums"), F.sum("s").alias("watch_durations"))
    videos = pairs.select(*ANCHOR, "vid").distinct().select(*ANCHOR, F.lit(1).alias("videos"))
    stacked = days.withColumn("active_days", F.lit(1)).drop("date_day").unionByName(videos, allowMissingColumns=True)
    found = stacked.groupBy(*ANCHOR).agg(*[F.sum(c).alias(c) for c in ("active_days", "watch_nums", "videos", "watch_durations")])
    counts = ("active_days", "watch_nums", "videos")
    out = anchors.select(*ANCHOR).distinct().join(found, list(ANCHOR), "left")
    return out.select(*ANCHOR, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts], "watch_durations")
