"""Left joins to lookup tables that hold under size and skew.

A lookup table is broadcast only when its measured row count times its row width stays
under ``BROADCAST_BYTES``. Beyond that it is a shuffle join in which the rows of every
heavy key are spread over salts, the lookup row being repeated once per salt.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

BROADCAST_BYTES = 64 * 1024 * 1024
LITERAL_KEYS = 200  # heavy keys that conditions name one by one; more of them are a table
TASK_ROWS = 1_000_000  # rows of one key that one task takes without splitting
LOST = 1 << 16  # parts that rows without a key are dealt to


@dataclass(frozen=True)
class Heavy:
    """Keys that hold more rows than one task should take.

    Each holds over ``per_task`` rows, so there are at most as many as the table has tasks' worth.
    Where they are many they stay a table, ``table`` (key, rows), whose few bytes per task's worth of
    rows are broadcast.
    """

    keys: tuple = ()
    most_rows: int = 0
    per_task: int = TASK_ROWS
    nulls: bool = False  # the missing key is heavy too
    table: DataFrame | None = None

    @property
    def any(self) -> bool:
        return bool(self.keys) or self.nulls or self.table is not None

    @property
    def salts(self) -> int:
        return max(2, math.ceil(self.most_rows / self.per_task))

    def marked(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a column that tells whether its key is heavy; a missing key is so if ``nulls``."""
        if self.table is None:
            held = F.col(key).isin(*self.keys) if self.keys else F.lit(False)
            return df.withColumn(name, F.coalesce(held, F.lit(self.nulls)) if self.keys else F.when(F.col(key).isNull(), F.lit(self.nulls)).otherwise(held))
        few = F.broadcast(self.table.where("key IS NOT NULL").select(F.col("key").alias("_heavy")))
        return df.join(few, F.col(key) == F.col("_heavy"), "left").withColumn(
            name, F.when(F.col(key).isNull(), F.lit(self.nulls)).otherwise(F.col("_heavy").isNotNull())).drop("_heavy")


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; combined before the shuffle, so a heavy key is one row per task."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def heavy_keys(counts: DataFrame, task_rows: int = TASK_ROWS, literals: int = LITERAL_KEYS) -> Heavy:
    """The keys of a table (key, rows) that hold more than one task's rows: exact, and few by their own size."""
    over = counts.where(F.col("rows") > task_rows)
    n, most, missing = over.agg(F.count(F.lit(1)), F.max("rows"), F.count_if(F.col("key").isNull())).first()
    if n <= literals:
        return Heavy(tuple(r["key"] for r in over.where("key IS NOT NULL").collect()), most or 0, task_rows, missing > 0)
    return Heavy((), most, task_rows, missing > 0, settle(over, "heavy"))


def spread_keys(
    left: DataFrame, right: DataFrame, key: str, heavy: Heavy, spread_on: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``_salt``: heavy keys' rows of ``left`` are dealt to salts, those of ``right`` repeated for each."""
    if not heavy.any:
        return left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0))
    salts = heavy.salts
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_on]), F.lit(salts)).cast("int")
    all_salts = F.when(F.col("_split"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = heavy.marked(left, key, "_split").withColumn("_salt", F.when(F.col("_split"), spread).otherwise(F.lit(0))).drop("_split")
    return left, heavy.marked(right, key, "_split").withColumn("_salt", F.explode(all_salts)).drop("_split")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    *,
    right_rows: int | None,
    row_bytes: int,
    heavy: Heavy,
    spread_on: list[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row per ``keys``.

    ``heavy`` lists values of the last key; ``spread_on`` are left columns that differ
    between the rows of one heavy key. A lookup table of unknown size is not broadcast.
    """
    if right_rows is not None and right_rows * row_bytes <= limit:
        return left.join(F.broadcast(right), keys, "left")
    return salted_join(left, right, keys, heavy, spread_on)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], heavy: Heavy, spread_on: list[str]
) -> DataFrame:
    """As a left join. Rows with a missing key match nothing: they are dealt to all tasks, not sent to one."""
    none = " OR ".join(f"`{k}` IS NULL" for k in keys)
    # a key that only such rows have, so that they need no second pass over ``left``
    lost = F.when(F.expr(none), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_on]), F.lit(LOST))).otherwise(F.lit(-1)).cast("int")
    salted, repeated = spread_keys(left, right, keys[-1], replace(heavy, nulls=False), spread_on)
    salted = salted.withColumn("_lost", lost)
    for k in keys:
        repeated = repeated.withColumnRenamed(k, f"_r_{k}")
    on = (F.col("_salt") == F.col("_r_salt")) & (F.col("_lost") == F.col("_r_lost"))
    repeated = repeated.withColumnRenamed("_salt", "_r_salt").withColumn("_r_lost", F.lit(-1))
    for k in keys:
        on = on & (F.col(f"`{k}`") == F.col(f"_r_{k}"))
    out = salted.join(repeated, on, "left")
    rest = [c for c in right.columns if c not in keys]
    return out.select(*[F.col(f"`{c}`") for c in keys], *[F.col(f"`{c}`") for c in left.columns if c not in keys], *[F.col(f"`{c}`") for c in rest])
