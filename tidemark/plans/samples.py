"""Label tables, wide samples and the stacked training table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.labels import label_table, users
from tidemark.plans.spec import Spec
from tidemark.plans.splits import Layout, label_members
from tidemark.sources.schema import LABELS

# fixed values: columns that are keys, labels or predictions, never features
NOT_FEATURES = (
    "did", "active_days", "active_days_preds", "watch_nums", "watch_nums_preds",
    "watch_durations", "watch_durations_preds", "split", "fold",
)


def split_labels(localized: DataFrame, layout: Layout) -> DataFrame:
    """Labels of every split in one pass; ``test`` has none."""
    return label_table(label_members(localized, layout), "split", "did")


def tenure(events: DataFrame, layout: Layout, compat: bool = False) -> DataFrame:
    """Hours from a user's first event to the last event of the split's history.

    ``compat`` keeps the slip of dividing only the first event's time, which the
    validation and test sets once had.
    """
    at = layout.position()
    hits = [
        F.when(at.between(*s.history), F.struct(F.lit(s.name).alias("split"), F.lit(s.anchor).alias("anchor")))
        for s in layout.splits if s.anchor is not None
    ]
    first = (
        events.withColumn("_s", F.explode(F.array_compact(F.array(*hits))))
        .groupBy("_s.split", "did", F.col("_s.anchor").alias("anchor"))
        .agg(F.min("timestamp").alias("first"))
    )
    whole = (F.col("anchor") - F.col("first")) / F.lit(3600.0)
    slipped = F.col("anchor") - F.col("first") / F.lit(3600.0)
    value = F.when(F.col("split").startswith("train"), whole).otherwise(slipped) if compat else whole
    return first.select("split", "did", value.alias("activa_time"))


def wide_features(long: DataFrame, spec: Spec, windows: tuple[int, ...] | None = None) -> DataFrame:
    """One row per ``split, did``: each window's features side by side.

    A user has at most one row per window, so the gathered list is as short as the list
    of windows. It is an aggregation rather than a join per window: one shuffle.
    """
    windows = windows or spec.windows
    names = [f.name for f in spec.features]
    row = F.struct("days", *[F.col(f"`{c}`") for c in names])
    gathered = (
        long.where(F.col("days").isin(*windows)).groupBy("split", "did")
        .agg(F.map_from_entries(F.collect_list(F.struct("days", row.alias("row")))).alias("by_days"))
    )
    opened = gathered.select(
        "split", "did", *[F.expr(f"try_element_at(by_days, {d})").alias(f"_{d}") for d in windows]
    )
    return opened.select("split", "did", *[
        F.expr(f"_{d}.`{f.name}` AS `{f.wide(d)}`") for d in windows for f in spec.at(d)
    ])


def samples(
    localized: DataFrame, long: DataFrame, layout: Layout, spec: Spec,
    windows: tuple[int, ...] | None = None, extra: DataFrame | None = None,
) -> DataFrame:
    """Labels (or, for test, users) with the features of every window.

    Every labelled user is kept; one without history has NULL features.
    """
    wide = wide_features(long, spec, windows)
    rows = split_labels(localized, layout)
    if any(s.label is None for s in layout.splits):
        everyone = users(localized).withColumn("split", F.lit("test"))
        rows = rows.unionByName(everyone, allowMissingColumns=True)
    out = rows.join(wide, ["split", "did"], "left")
    return out if extra is None else out.join(extra, ["split", "did"], "left")


def stack(*tables: DataFrame) -> DataFrame:
    """Rows of several sample tables, matched by column name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def feature_columns(df: DataFrame, exclude=NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def training_rows(sample: DataFrame) -> DataFrame:
    return sample.where(F.col("split") != "test")


def test_rows(sample: DataFrame) -> DataFrame:
    return sample.where(F.col("split") == "test").drop(*LABELS)
