"""Approximate nearest neighbours: a small-world graph per shard, results of the shards merged.

Rows are dealt to shards by a hash of id and vector, whatever the vectors are, so
copies of one vector are spread. Each shard's graph is written once as flat arrays. Query blocks
then meet every shard; a task holds one graph and one block. Shards and blocks are as large as a task's
memory allows, for a graph's search grows far slower than its rows: fewer, larger shards are less work.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import hnsw
from tidemark.llm.common import settle


@dataclass(frozen=True)
class Params:
    k: int = 10
    shard_bytes: int = 64 << 20  # of the vectors and links of a shard, about
    block_bytes: int = 64 << 20  # of the queries that meet a shard in one task, about
    graph: hnsw.Params = hnsw.Params()

    def row_bytes(self, dim: Column) -> Column:
        return (dim * 8 + self.graph.links * 16).cast("long")


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def index(rows: DataFrame, shards: int, p: Params) -> DataFrame:
    """(dim, shard, graph) of ``rows`` (vec_id, embedding), written once; every row is in one graph."""
    def built(group: pd.DataFrame) -> pd.DataFrame:
        graph = hnsw.build(group.vec_id.to_numpy(np.int64), np.stack(group.embedding.to_list()), p.graph)
        flat = {**vars(graph), "layers": [layer.astype(np.int32) for layer in graph.layers]}
        return pd.DataFrame({"dim": group.dim[:1], "shard": group.shard[:1], "graph": [pickle.dumps(flat)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    return settle(dealt.groupBy("dim", "shard").applyInPandas(built, "dim int, shard int, graph binary"), "graphs")


def search(vectors: DataFrame, queries: DataFrame, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` nearest rows, those of its own id left out.

    Both tables have vec_id and embedding. Rows without an id or without a usable vector take no
    part; vectors meet those of their own dimension only. Of a query id's vectors the smallest
    is searched for; rows that repeat an id are candidates each. Without queries or candidates
    the result is empty.
    """
    def valid(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.size("embedding").alias("dim"))

    rows, asked = valid(vectors), valid(queries).groupBy("dim", "vec_id").agg(F.min("embedding").alias("embedding"))
    def parts(df: DataFrame, most: int) -> int:
        return max(1, -(-(df.agg(F.sum(p.row_bytes(F.col("dim")))).first()[0] or 0) // most))

    shards, blocks = parts(rows, p.shard_bytes), parts(asked, p.block_bytes)
    graphs = index(rows, shards, p)
    kind = vectors.schema["embedding"].dataType.simpleString()
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "dim", "shard", "block", "graph", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast(kind).alias("embedding"))
    meet = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        "dim", "shard", "block", F.lit(None).cast("binary").alias("graph"), "vec_id", "embedding")

    def found(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        asked = group[group.graph.isnull()]
        kept = group[group.graph.notnull()]
        if not len(asked) or not len(kept):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        flat = pickle.loads(kept.graph.iloc[0])
        graph = hnsw.Graph(**{**flat, "layers": [layer.astype(np.int64) for layer in flat["layers"]]})
        made = hnsw.nearest(graph, asked.vec_id.to_numpy(np.int64), np.stack(asked.embedding.to_list()), p.k, p.graph)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), made, strict=True)))

    near = held.unionByName(meet).groupBy("dim", "shard", "block").applyInPandas(found, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 100, searched for among all rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
