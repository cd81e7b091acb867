"""Scores, clipping, blending and key checks of prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.schema import LABELS

# fixed values: shares of the composite score and the ranges predictions are cut to
SHARES = {"active_days": 0.5, "watch_nums": 0.25, "watch_durations": 0.25}
RANGES = {"active_days": (1.0, 7.0), "watch_nums": (0.0, None), "watch_durations": (0.0, None)}


def r2_scores(scored: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """One row: R² of each label against its prediction column, over rows that have both.

    One aggregate: rows times the population variance is the sum of squares about the mean.
    """
    out = []
    for y, p in pairs.items():
        both = F.col(y).isNotNull() & F.col(p).isNotNull()
        label, gap = F.when(both, F.col(y)), F.col(y) - F.col(p)
        total = F.count(label) * F.var_pop(label)
        out.append((1 - F.try_divide(F.sum(gap * gap), total)).alias(f"r2_{y}"))
    return scored.agg(*out)


def composite_score(scores: DataFrame) -> DataFrame:
    total = sum((F.lit(w) * F.col(f"r2_{y}") for y, w in SHARES.items()), F.lit(0.0))
    return scores.select("*", total.alias("score"))


def clipped(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` within its range; NULL stays NULL (``least`` alone would replace it)."""
    out = value
    if high is not None:
        out = F.least(out, F.lit(high))
    if low is not None:
        out = F.greatest(out, F.lit(low))
    return F.when(value.isNotNull(), out)


def clip_predictions(df: DataFrame, labels=LABELS) -> DataFrame:
    return df.withColumns({c: clipped(F.col(c), *RANGES[c]) for c in labels})


def rename_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in LABELS})


def prediction_columns(df: DataFrame) -> DataFrame:
    return df.select("did", *LABELS)


def blend(first: DataFrame, second: DataFrame, weight: float = 0.5) -> DataFrame:
    """Weighted mean of two prediction tables over the users of the first.

    Active days are clipped afterwards; a user the second lacks has no blend.
    """
    both = rename_suffix(first, "_1").join(rename_suffix(second, "_2"), "did", "left")
    mixed = both.select("did", *[
        (F.lit(weight) * F.col(f"{c}_1") + F.lit(1 - weight) * F.col(f"{c}_2")).alias(c) for c in LABELS
    ])
    return clip_predictions(mixed, ["active_days"])


def key_mismatch(first: DataFrame, second: DataFrame) -> DataFrame:
    """Users that only one of two prediction tables has."""
    a = first.select(F.col("did").alias("did1"))
    b = second.select(F.col("did").alias("did2"))
    return a.join(b, F.col("did1") == F.col("did2"), "full_outer").where("did1 IS NULL OR did2 IS NULL")
