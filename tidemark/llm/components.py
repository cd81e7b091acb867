"""Connected components of a graph given as a table of links, by alternating stars.

Each round is two group-by-minimum steps: every node hangs its larger neighbours, then its
smaller ones, on the smallest node it knows. No node's neighbours are ever gathered. Rounds
grow with the logarithm of the longest path; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (high, low) with high > low, rehung on each node's smallest neighbour."""
    if large:
        near = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            links.select(F.col("low").alias("node"), F.col("high").alias("other")))
    else:
        near = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = near.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    rehung = near.join(least, "node")
    if large:
        rehung = rehung.where(F.col("other") > F.col("node"))
    moved = rehung.where(F.col("other") != F.col("least")).select(F.col("other").alias("high"), F.col("least").alias("low"))
    if not large:
        moved = moved.unionByName(least.select(F.col("node").alias("high"), F.col("least").alias("low")))
    return moved.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it reaches.

    ``links`` has two columns of one sortable type, in any order, with repeats or not.
    """
    a, b = (F.col(c) for c in links.columns)
    now = settle(
        links.where(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        now = settle(_stars(_stars(now, True), False), "links")
    roots = now.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("root"))
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
