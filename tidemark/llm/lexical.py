"""Ranked lexical search with range-maximum sparse tables.

The items asked come in blocks of bounded vocabulary. One pass over the texts keeps, for each
document, its length and how often it holds each term of the block; what a term weighs follows
from the counts of all documents. A task then makes shards of the documents it reads: posting lists
by document place with whole-number impacts, and over them a table of where the largest impact
lies in every run of 1, 2, 4, ... postings. An item starts with the interval of all documents of
the shard. The interval with the largest bound, the sum of its terms' range maxima, is taken; the document of
the largest impact is scored and the interval split there; short intervals are scored whole. No
interval whose bound is below the worst of the best found so far is looked into. Nothing but the
best of each task is shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle

#: UTF-8 bytes of a term as they are, A-Z lower-cased, all others a blank; bytes from 0x80 on belong to terms.
BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
NO_ID = np.iinfo(np.int64).max  # stands for a missing id, after all others


@dataclass(frozen=True)
class Params:
    k: int = 10
    block_bytes: int = 4 << 20  # of the texts of the items asked at once, about
    shard_rows: int = 16_384  # documents of a shard
    shard_postings: int = 1 << 20  # and about so many postings
    leaf: int = 256  # documents of an interval that is scored whole


def terms(text: bytes) -> list[bytes]:
    return text.translate(BYTES).split()


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _held(vocabulary: dict[bytes, int]):
    """For batches (doc_id, text): each document's length and the terms of the vocabulary in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lengths, which, often = [], [], []
                for value in part.column(1):
                    found = terms(value.as_buffer().to_pybytes()) if value.is_valid else []
                    lengths.append(len(found))
                    here = {k: c for t, c in Counter(found).items() if (k := vocabulary.get(t)) is not None}
                    which.append(np.fromiter(here.keys(), np.int32, len(here)))
                    often.append(np.fromiter(here.values(), np.int64, len(here)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))],
                    names=["doc_id", "length", "terms", "often"])

    return run


class Shard:
    """Posting lists of some documents, which come in the order of their ids, and the tables over them."""

    def __init__(self, ids: np.ndarray, owner: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """``owner``: each posting's document, by place in ``ids``."""
        order = np.lexsort((owner, term))
        self.ids, self.size = ids, len(ids)
        self.owner, self.impact = owner[order].astype(np.int64), impact[order]
        self.place = term[order].astype(np.int64) * self.size + self.owner  # rising over all lists
        longest = int(np.unique(term, return_counts=True)[1].max(initial=1))
        self.best = [np.arange(len(order), dtype=np.int32)]  # where the largest of 2^level postings lies, the first of equals
        for level in range(1, longest.bit_length()):
            half = 1 << (level - 1)
            left, right = self.best[-1][:-half], self.best[-1][half:]
            if not len(left):
                break
            self.best.append(np.where(self.impact[left] >= self.impact[right], left, right))

    def ranges(self, term: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The postings of each term from document ``lo`` to before ``hi``."""
        at = term * self.size
        return np.searchsorted(self.place, at + lo), np.searchsorted(self.place, at + hi)

    def largest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The posting of the largest impact in each range, none of which is empty."""
        level = np.frexp((last - first).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for l in np.unique(level):
            at = level == l
            left, right = self.best[l][first[at]], self.best[l][last[at] - (1 << int(l))]
            out[at] = np.where(self.impact[left] >= self.impact[right], left, right)
        return out


def search(shard: Shard, term: np.ndarray, times: np.ndarray, top: list[tuple[int, int]], p: Params) -> list[tuple[int, int]]:
    """``top``, a heap of (score, -id) of at most ``k``, with what the shard adds for an item's terms."""
    def bounded(lo: int, hi: int, term: np.ndarray, times: np.ndarray):
        first, last = shard.ranges(term, lo, hi)
        some = last > first
        if not some.any():
            return None
        term, times, first, last = term[some], times[some], first[some], last[some]
        peak = shard.largest(first, last)
        most = shard.impact[peak] * times
        return -int(most.sum()), lo, hi, term, times, first, last, int(shard.owner[peak[most.argmax()]])

    def offer(score: int, doc: int) -> None:
        entry = (score, -int(shard.ids[doc]))
        if len(top) < p.k:
            heapq.heappush(top, entry)
        elif entry > top[0]:
            heapq.heapreplace(top, entry)

    start = bounded(0, shard.size, term, times)
    heap, turn = ([(start[0], 0, start)] if start else []), 1
    while heap:
        bound, _, (_, lo, hi, term, times, first, last, middle) = heapq.heappop(heap)
        if len(top) == p.k and -bound < top[0][0]:
            break
        if hi - lo <= p.leaf:
            counts = last - first
            at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            scores = np.zeros(hi - lo, np.int64)
            np.add.at(scores, shard.owner[at] - lo, shard.impact[at] * np.repeat(times, counts))
            best = np.flatnonzero(scores >= (top[0][0] if len(top) == p.k else 1))
            for doc in best[np.argsort(-scores[best], kind="stable")][: p.k]:
                if scores[doc] > 0:
                    offer(int(scores[doc]), lo + int(doc))
            continue
        place = np.searchsorted(shard.place, term * shard.size + middle)
        there = (place < last) & (shard.owner[np.minimum(place, len(shard.owner) - 1)] == middle)
        score = int((shard.impact[place[there]] * times[there]).sum())
        if score > 0:
            offer(score, middle)
        for a, b in ((lo, middle), (middle + 1, hi)):
            part = bounded(a, b, term, times) if b > a else None
            if part and not (len(top) == p.k and -part[0] < top[0][0]):
                heapq.heappush(heap, (part[0], turn, part))
                turn += 1
    return top


def _impacts(lengths: np.ndarray, owner: np.ndarray, term: np.ndarray, often: np.ndarray, weights: np.ndarray, n: int, total: int) -> np.ndarray:
    m = np.array([25 + 75 * int(x) * n // total for x in lengths], np.int64)
    return weights[term] * ((1_000_000_000 * often) // (1000 * often + 8 * m[owner]))


def _ranked(items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, n: int, total: int, p: Params):
    """For batches of held terms: the best documents of the task for each item."""
    def made(parts: list[pa.RecordBatch]) -> Shard | None:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        lengths = table.column("length").to_numpy()
        lists = table.column("terms").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        term, often = lists.flatten().to_numpy(), table.column("often").combine_chunks().flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        owner = np.repeat(np.arange(len(ids)), sizes)
        impact = _impacts(lengths, owner, term, often, weights, n, total)
        return Shard(ids[order], place[owner], term, impact) if len(term) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list[tuple[int, int]]] = [[] for _ in items]

        def look(parts: list[pa.RecordBatch]) -> None:
            shard = made(parts) if parts else None
            for (_, term, times), top in zip(items, tops, strict=True) if shard else ():
                search(shard, term, times, top, p)

        parts, rows, postings = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                parts.append(part)
                rows += part.num_rows
                postings += len(part.column(2).flatten())
                if rows >= p.shard_rows or postings >= p.shard_postings:
                    look(parts)
                    parts, rows, postings = [], 0, 0
        look(parts)
        found = [(item, -doc, score) for (item, _, _), top in zip(items, tops, strict=True) for score, doc in top]
        ids = pa.array([None if doc == NO_ID else doc for _, doc, _ in found], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in found], pa.int64()), ids, pa.array([x[2] for x in found], pa.int64())], names=["item_id", "doc_id", "score"])

    return run


def _block(docs: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """(item_id, doc_id, score) of the best of each task, for the items of one block."""
    asked = [(r.item_id, Counter(terms(r.text.encode()))) for r in items.orderBy("item_id").collect()]  # block_bytes, about
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*[c for _, c in asked])))}
    held = settle(docs.mapInArrow(_held(vocabulary), "doc_id long, length long, terms array<int>, often array<long>"), "held-terms")
    n, total = held.where("length > 0").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    counts = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()  # one per term asked
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    for r in counts:
        weights[r.term] = weight(r.n, n)
    queries = [(i, np.array([vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for i, c in asked if c]
    return held.mapInArrow(_ranked(queries, weights, n, max(1, total), p), "item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents of ``docs`` (doc_id, text).

    A null or termless text is found by nothing, finds nothing and is not counted. A document
    without an id is counted and found as any other, after those of its score; rows that repeat an
    id are documents each. Items without an id are not asked; of an item id's texts the smallest
    is. An item whose terms no document holds has no rows; empty tables give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    items = settle(items, "items")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // p.block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = reduce(DataFrame.unionByName, [settle(_block(docs, dealt.where(F.col("block") == b), p), "ranked") for b in range(blocks)])
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_lexical(spark, sf_dir: str) -> DataFrame:
    """All documents ranked for every benchmark item."""
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
