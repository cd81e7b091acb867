"""Which events belong to which split: label ranges, histories and anchors.

Split bounds depend on the data (the last event of the table, the last event present in
each history). They are five numbers per split, read in aggregate jobs and then used
as literals, so range conditions need no join. ``reach`` and ``label_reach`` give them as epoch
seconds for sources that can filter their stored time column.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY_SECONDS, LOCAL_ZONE, day_number, local_day
from tidemark.functions.measures import decay_weight
from tidemark.operators.joins import TASK_ROWS, Heavy, heavy_keys, key_counts
from tidemark.session import settle

CALENDAR, ROLLING = "calendar", "rolling"


@dataclass(frozen=True)
class Split:
    """Bounds are day numbers (calendar) or epoch seconds (rolling), both ends kept."""

    name: str
    label: tuple[int, int] | None
    history: tuple[int, int]
    anchor: int | None = None


@dataclass(frozen=True)
class Catalogue:
    """How far before the last event each split ends; ``test`` uses everything."""

    mode: str
    offsets: tuple[tuple[str, int], ...]
    label_days: int
    gap: int
    history_days: int
    compat: bool = False
    test: bool = True

    def bounds(self, last: int) -> list[Split]:
        unit = 1 if self.mode == CALENDAR else DAY_SECONDS
        # rolling label and history would share their common instant
        gap = self.gap * unit + (0 if self.mode == CALENDAR or self.compat else 1)
        out = []
        for name, off in self.offsets:
            end = last - off * unit
            seen = end - gap
            first = end - (self.gap + self.history_days) * unit
            out.append(Split(name, (end - self.label_days * unit, end), (first, seen)))
        if self.test:
            out.append(Split("test", None, (-(2**62), last)))
        return out


SET_1 = Catalogue(CALENDAR, (("train_3", 14), ("train_2", 7), ("train_1", 3), ("valid", 0)), 6, 7, 120)
SET_2 = Catalogue(CALENDAR, (("train_3", 21), ("train_2", 14), ("train_1", 7), ("valid", 0)), 6, 7, 120)
BASELINE = Catalogue(ROLLING, (("train_1", 7), ("valid", 0)), 7, 7, 777)
LATEST = Catalogue(CALENDAR, (), 6, 7, 120)  # only the full history, as for test users


@dataclass(frozen=True)
class Layout:
    """What planning needs to know about the data."""

    mode: str
    last: int
    splits: tuple[Split, ...]
    rows: int = 0
    items_seen: int | None = None  # unknown: tables that grow with it are not broadcast
    users: Heavy = field(default_factory=Heavy)
    items: Heavy = field(default_factory=Heavy)
    zone: str = LOCAL_ZONE

    def position(self) -> Column:
        return day_number(F.col("date_day")) if self.mode == CALENDAR else F.col("timestamp")

    def only(self, *names: str) -> Layout:
        return replace(self, splits=tuple(s for s in self.splits if s.name in names))


def survey(
    events: DataFrame,
    catalogue: Catalogue,
    zone: str = LOCAL_ZONE,
    skew: bool = True,
    task_rows: int = TASK_ROWS,
) -> Layout:
    """Resolve the splits against ``events`` and find heavy keys.

    One pass counts events per local day (calendar) or takes the bounds (rolling); with
    ``skew`` two more count rows per user and per video, combined before they are shuffled,
    and only keys with more than ``task_rows`` rows come to the driver.
    """
    if catalogue.mode == CALENDAR:
        days = events.groupBy(day_number(local_day(F.col("timestamp"), zone)).alias("p")).agg(F.count(F.lit(1)).alias("rows"))
        seen = sorted((r["p"], r["rows"]) for r in days.where("p IS NOT NULL").collect())  # one row per day
        if not seen:
            return Layout(catalogue.mode, 0, (), zone=zone)
        last, rows = seen[-1][0], sum(n for _, n in seen)
        anchors = [max((d for d, _ in seen if s.history[0] <= d <= s.history[1]), default=None) for s in catalogue.bounds(last)]
    else:
        last = events.agg(F.max("timestamp").alias("p")).first()["p"]
        if last is None:
            return Layout(catalogue.mode, 0, (), zone=zone)
        at = F.col("timestamp")
        asks = [F.max(F.when(at.between(*s.history), at)).alias(f"anchor_{i}") for i, s in enumerate(catalogue.bounds(last))]
        got = events.agg(*asks, F.count(F.lit(1)).alias("rows")).first()
        rows, anchors = got["rows"], [got[f"anchor_{i}"] for i in range(len(asks))]
    splits = tuple(replace(s, anchor=a) for s, a in zip(catalogue.bounds(last), anchors, strict=True))
    if not skew:
        return Layout(catalogue.mode, last, splits, rows, zone=zone)
    # both tables of counts are kept, so that each is made by one pass over the events
    items, users = (settle(key_counts(events, k), f"rows-by-{k}") for k in ("vid", "did"))
    return Layout(catalogue.mode, last, splits, rows, items.count(), heavy_keys(users, task_rows), heavy_keys(items, task_rows), zone)


def reach(layout: Layout, longest: int) -> tuple[int, int] | None:
    """Epoch seconds of the first and last event any window can reach; None if there is none.

    A day of slack on both sides covers every time zone.
    """
    unit = DAY_SECONDS if layout.mode == CALENDAR else 1
    back = longest * DAY_SECONDS
    firsts = [max(s.history[0] * unit, s.anchor * unit - back) for s in layout.splits if s.anchor is not None]
    lasts = [s.anchor * unit for s in layout.splits if s.anchor is not None]
    return (min(firsts) - DAY_SECONDS, max(lasts) + 2 * DAY_SECONDS) if firsts else None


def prune(events: DataFrame, layout: Layout, longest: int) -> DataFrame:
    """Drop events no window can reach."""
    bounds = reach(layout, longest)
    return _days_between(events, bounds) if bounds else events.where(F.lit(False))


def label_reach(layout: Layout) -> tuple[int, int] | None:
    """Epoch seconds around all label ranges, with a day of slack; None if there is none."""
    ranges = [s.label for s in layout.splits if s.label]
    unit = DAY_SECONDS if layout.mode == CALENDAR else 1
    return (min(r[0] for r in ranges) * unit - DAY_SECONDS, max(r[1] for r in ranges) * unit + 2 * DAY_SECONDS) if ranges else None


def history_reach(layout: Layout) -> tuple[int, int] | None:
    """Epoch seconds around all histories, with a day of slack."""
    unit = DAY_SECONDS if layout.mode == CALENDAR else 1
    ends = [s.history for s in layout.splits]
    return (max(min(h[0] for h in ends) * unit, -(2**50)) - DAY_SECONDS, max(h[1] for h in ends) * unit + 2 * DAY_SECONDS) if ends else None


def _days_between(df: DataFrame, bounds: tuple[int, int]) -> DataFrame:
    """Rows around two epoch seconds, by their time and, where they have it, their local day: with the day's slack
    that ``bounds`` have, no zone loses a row. Tables stored by day are read in part."""
    df = df.where(F.col("timestamp").between(*bounds))
    if "date_day" not in df.columns:
        return df
    first, last = (F.date_from_unix_date(F.lit(max(-719162, min(2932896, b // DAY_SECONDS)))) for b in bounds)
    return df.where(F.col("date_day").between(first, last))


def label_members(df: DataFrame, layout: Layout) -> DataFrame:
    """Each event once per split whose label range holds it."""
    at = layout.position()
    bounds = label_reach(layout)
    if not bounds:
        return df.where(F.lit(False)).withColumn("split", F.lit(""))
    df = _days_between(df, bounds)
    hits = [F.when(at.between(*s.label), F.lit(s.name)) for s in layout.splits if s.label]
    return df.withColumn("split", F.explode(F.array_compact(F.array(*hits))))


def history_members(df: DataFrame, layout: Layout) -> DataFrame:
    """Each event once per split whose history holds it."""
    at, bounds = layout.position(), history_reach(layout)
    if not bounds:
        return df.where(F.lit(False)).withColumn("split", F.lit(""))
    df = _days_between(df, bounds)
    hits = [F.when(at.between(*s.history), F.lit(s.name)) for s in layout.splits]
    return df.withColumn("split", F.explode(F.array_compact(F.array(*hits))))


def window_bands(layout: Layout, windows: tuple[int, ...]) -> dict[str, Column]:
    """For each split, the smallest window that holds a row of a local day (``band``); null where none does.

    As ``window_members`` for whole days, with a column per split where that makes a row.
    """
    at, longest, out = layout.position(), max(windows), {}
    for s in layout.splits:
        if s.anchor is None:
            continue
        band = F.lit(windows[-1])
        for d in reversed(windows[:-1]):
            band = F.when(F.lit(s.anchor) - at + 1 <= d, F.lit(d)).otherwise(band)
        first = max(s.history[0], s.anchor - longest + 1)
        out[s.name] = F.when(at.between(F.lit(first), F.lit(s.anchor)), band)
    return out


def window_members(df: DataFrame, layout: Layout, windows: tuple[int, ...]) -> DataFrame:
    """Each event once per split that can see it, with its smallest window.

    Windows of one split all end at its anchor, so the smallest window holding an event
    (``band``) tells all of them. Adds ``split``, ``band`` and the recency ``weight``.
    """
    at, longest = layout.position(), max(windows)
    unit = 1 if layout.mode == CALENDAR else DAY_SECONDS
    hits = []
    for s in layout.splits:
        if s.anchor is None:
            continue
        age = F.lit(s.anchor) - at
        if layout.mode == CALENDAR:  # ages 0 .. days-1
            reach, first = age + 1, max(s.history[0], s.anchor - longest + 1)
        else:  # ages up to days times 24 hours, both ends kept
            reach, first = age, max(s.history[0], s.anchor - longest * unit)
        inside = at.between(F.lit(first), F.lit(s.anchor))
        hits.append(F.when(inside, F.struct(F.lit(s.name).alias("split"), reach.alias("reach"))))
    if not hits:
        return df.where(F.lit(False)).withColumns(
            {"split": F.lit(""), "band": F.lit(0), "weight": F.lit(0.0)}
        )
    member = df.withColumn("_m", F.explode(F.array_compact(F.array(*hits))))
    band = F.lit(windows[-1])
    for d in reversed(windows[:-1]):
        band = F.when(F.col("_m.reach") <= d * unit, F.lit(d)).otherwise(band)
    whole_days = F.floor(F.col("_m.reach") / F.lit(unit)) + (0 if layout.mode == CALENDAR else 1)
    return member.withColumns({
        "split": F.col("_m.split"),
        "band": band,
        "weight": decay_weight(whole_days.cast("double")),
    }).drop("_m")
