"""Exact places of rows in an order, without bringing them to one task.

Rows are range-partitioned in the asked order and written; rows per partition, few numbers, give
what each partition's places begin at.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def placed(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``df`` with each row's place from 1 in ``order``; rows that are equal in it come in any order.

    Rows that agree in all of ``order`` are dealt to several partitions, too, so many equal
    values do not meet in one task.
    """
    tie = "_tie"
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, F.col(tie)).drop(tie)
    rows = rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    # the number has the partition above 33 bits and the place in it below
    rows = settle(rows.withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), "placed")
    counts = {r["_part"]: r["rows"] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).collect()}  # one per task
    sizes = [counts.get(k, 0) for k in range(max(counts, default=-1) + 1)]
    before = [0, *accumulate(sizes)][: max(1, len(sizes))]
    begins = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    return rows.withColumn(name, F.get(begins, F.col("_part")) + F.col("_at") + 1).drop("_part", "_at")


def even_folds(df: DataFrame, key: str | list[str] = "did", k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` with a ``fold`` of 0 to ``k`` - 1: keys are put in the order of a hash and dealt in turn.

    Folds differ by one key at most. By user, all rows of a user share a fold; with
    ``["split", "did"]`` rows are dealt one by one, as a shuffled k-fold does.
    """
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys])
    once = df.select(*keys).distinct().withColumn("_order", F.md5(text))
    dealt = placed(once, [F.col("_order"), *[F.col(c) for c in keys]], "_place")
    dealt = dealt.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.pmod(F.col("_place") - 1, F.lit(k)).cast("int").alias("fold"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    on = same[0]
    for one in same[1:]:
        on = on & one
    return df.join(dealt, on).drop(*[f"_k_{c}" for c in keys])


def value_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, rows, code) of the column's values: 0 for the most frequent, equal ones by value; missing has none.

    The dictionary is a table: it may hold any number of values.
    """
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return placed(counts, [F.desc("rows"), F.asc("value")], "code").withColumn("code", F.col("code") - 1)
