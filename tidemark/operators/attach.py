"""Group aggregates attached to rows, for one set of rows at a time.

The feature build attaches at group level instead (see ``plans.features``); these are
the plain forms for a table a user already has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_BYTES, Heavy, lookup_join

from tidemark.operators.labels import label_table


GROUP_ROW_BYTES = 128


def group_activity(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Active days, watches and seconds watched per group."""
    return label_table(df, *keys).withColumnsRenamed({
        "active_days": f"{prefix}_active_days",
        "watch_nums": f"{prefix}_watch_nums",
        "watch_durations": f"{prefix}_watch_durations",
    })


def group_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def attach(
    df: DataFrame, keys: list[str], groups: DataFrame, *, spread_on: list[str] | None = None,
    heavy: Heavy = Heavy(nulls=True), groups_rows: int | None = None, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with their group's aggregates; a NULL key matches nothing.

    ``heavy`` names values of the last key that hold more rows than a task should take; their
    rows, and those whose key is NULL, are spread by ``spread_on`` (all other columns).
    """
    rest = [c for c in df.columns if c not in keys]
    return lookup_join(
        df, groups, keys, right_rows=groups_rows, row_bytes=GROUP_ROW_BYTES, heavy=heavy,
        spread_on=spread_on or rest or keys, limit=limit)


def top_values(df: DataFrame, key: str, value: str, k: int = 1) -> DataFrame:
    """The ``k`` most frequent values per key; ties go to the larger value.

    Values are counted first, so ranking sees one row per (key, value). For ``k`` = 1 the
    ranking itself is a combinable aggregate.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("rows"))
    best = F.struct(F.col("rows"), F.col(value))
    if k == 1:
        return counts.groupBy(key).agg(F.max(best).alias("b")).select(
            key, F.col(f"b.{value}").alias(value), F.col("b.rows").alias("rows"), F.lit(1).alias("rank")
        )
    ranked = Window.partitionBy(key).orderBy(F.desc("rows"), F.desc(value))
    # the rank filter is applied before the shuffle as well (a group limit), so a key
    # with very many values sends at most k of them per task
    return counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
