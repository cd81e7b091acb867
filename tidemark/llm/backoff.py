"""Language-model scores with stupid backoff, computed by joins.

The model of a document is all other documents: of every n-gram's count, the document's own
occurrences are taken off, so that a text is never told by itself. A word scores the count of the
longest n-gram, up to ``order`` words, that ends there and is seen elsewhere, over the count of its
words before; each word that the context is cut by costs a factor ``alpha``. A single word scores
its share of all words elsewhere, one not seen elsewhere ``alpha`` times that of one word. No
n-gram is pruned.

Texts are dealt to chunks of bounded size. A chunk's distinct n-grams, by the hash of their words,
go with their counts to ranges of the key and are summed there; a key comes at most once from
each chunk, however frequent it is. A chunk gets back only what it does not know itself: the sums
of n-grams that other chunks hold, too. The key space is worked through in ``slices``, which
divides the space that shuffles take. Last, chunks meet their sums, as many of them at a time, and
score their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle
from tidemark.llm.grams import mix, word_hashes

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    order: int = 3  # words of the longest n-gram
    alpha: float = 0.4
    slices: int = 4
    chunk_words: int = 1 << 18  # about; a longer text is a chunk of its own
    range_keys: int = 1 << 19  # that are summed together, about


def chunks(docs: DataFrame, p: Params) -> DataFrame:
    """(chunk, words, sizes, ids), written once: the word hashes of some texts, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, words, held = [], [], 0

        def made() -> pa.RecordBatch:
            joined = np.concatenate(words).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.ListArray.from_arrays([0, len(joined)], pa.array(joined)),
                 pa.array([[len(w) for w in words]], pa.list_(pa.int32())), pa.array([ids], pa.list_(pa.int64()))],
                names=["chunk", "words", "sizes", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for one, found in zip(some.column(0).to_pylist(), word_hashes(some.column(1).to_pylist()), strict=True):
                    ids.append(one)
                    words.append(found)
                    held += len(found)
                    if held >= p.chunk_words or len(ids) >= p.chunk_words:
                        yield made()
                        ids, words, held, number = [], [], 0, number + 1
        if ids:
            yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, "chunk long, words array<long>, sizes array<int>, ids array<long>")
    # few chunks in a row group, so that a reader holds few at once; words recur, so a dictionary pays
    return settle(found, "chunks", **{"parquet.block.size": 8 << 20, "parquet.block.row.count.limit": 4, "parquet.dictionary.page.size": 4 << 20})


def gram_keys(words: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``: the key of the n-gram that ends at each word; 0 where the text begins later.

    ``place`` is each word's place in its text.
    """
    out, rolled = [], np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        rolled = words.copy() if n == 1 else np.append(np.zeros(1, np.uint64), rolled[:-1]) * _MULTIPLIER + words
        keys = mix(rolled + np.uint64(n))
        keys[place < n - 1] = 0
        out.append(keys)
    return out


def _chunk_keys(words: np.ndarray, sizes: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a chunk, the single words' first, and each word's place in its text."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - np.repeat(starts, sizes)
    return np.concatenate([*gram_keys(words.view(np.uint64), place, p.order), np.zeros(0, np.uint64)]), place


def _in_slice(keys: np.ndarray, which: int, p: Params) -> np.ndarray:
    return np.flatnonzero((keys != 0) & ((keys >> np.uint64(32)) % np.uint64(p.slices) == which))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    for value in column:
        yield value.values.to_numpy(zero_copy_only=False)


def _shares(table: pa.Table) -> pa.Table:
    """Of one range of keys, in rows (chunk, first, keys, counts): for each chunk the places and totals of keys that others hold, too."""
    sizes = pc.list_value_length(table.column("keys")).to_numpy()
    keys, n = (pc.list_flatten(table.column(c)).to_numpy() for c in ("keys", "counts"))
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = (np.arange(len(keys)) + np.repeat(table.column("first").to_numpy() - (np.cumsum(sizes) - sizes), sizes)).astype(np.int32)
    order = np.argsort(keys)
    first = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(keys) else np.zeros(0, np.int64)
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(keys)))) if len(keys) else 0
    more = np.flatnonzero(total > n)  # in the order of the rows
    ends = pa.array(np.searchsorted(row[more], np.arange(len(sizes) + 1)), pa.int32())
    return pa.table({"chunk": table.column("chunk"), "places": pa.ListArray.from_arrays(ends, pa.array(place[more])),
                     "totals": pa.ListArray.from_arrays(ends, pa.array(total[more]))})


def sums(made: DataFrame, which: int, total: int, p: Params) -> DataFrame:
    """(chunk, slice, places, totals) of one slice: the counts of a chunk's n-grams that other chunks hold, too.

    ``places`` are the n-grams' among the chunk's of the slice, by key. Keys travel as arrays, one for each
    range of keys that a chunk has some of; the ranges are as many as keep about ``range_keys`` in each.
    """
    bits = min(24, max(0, (total * p.order // (p.slices * p.range_keys)).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
        for batch in batches:
            for chunk, words, sizes in zip(batch.column(0).to_pylist(), _lists(batch.column(1)), _lists(batch.column(2)), strict=True):
                keys, _ = _chunk_keys(words, sizes, p)
                found, counts = np.unique(keys[_in_slice(keys, which, p)], return_counts=True)
                ends = np.append(np.searchsorted(found, edges), len(found))
                part = np.flatnonzero(np.diff(ends))
                lists = pa.array(np.append(ends[part], len(found)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), chunk)), pa.array(ends[part]),
                     pa.ListArray.from_arrays(lists, pa.array(found.view(np.int64))), pa.ListArray.from_arrays(lists, pa.array(counts.astype(np.int32)))],
                    names=["part", "chunk", "first", "keys", "counts"])

    rows = made.select("chunk", "words", "sizes").mapInArrow(run, "part int, chunk long, first long, keys array<long>, counts array<int>")
    found = rows.groupBy("part").applyInArrow(_shares, "chunk long, places array<int>, totals array<long>")
    return settle(found.withColumn("slice", F.lit(which)), "sums")


def chunk_scores(words: np.ndarray, sizes: np.ndarray, known: dict[int, tuple[np.ndarray, np.ndarray]], total: int, p: Params) -> np.ndarray:
    """The mean log score of each text of a chunk; NaN of one without words.

    ``known``: for each slice, the places of n-grams that other chunks hold and their counts.
    """
    keys, place = _chunk_keys(words, sizes, p)
    text = np.repeat(np.arange(len(sizes)), sizes)
    texts, elsewhere = np.tile(text, p.order), np.zeros(len(keys), np.int64)
    for which in range(p.slices):
        at = _in_slice(keys, which, p)
        found, gram, counts = np.unique(keys[at], return_inverse=True, return_counts=True)
        if which in known:
            counts[known[which][0]] = known[which][1]
        _, pair, own = np.unique(gram * len(sizes) + texts[at], return_inverse=True, return_counts=True)
        elsewhere[at] = counts[gram] - own[pair]
    by_order = elsewhere.reshape(p.order, len(words))
    others = np.maximum(total - sizes, 1)[text]  # words elsewhere
    cut = np.log(p.alpha)
    longest = np.minimum(place + 1, p.order)
    with np.errstate(divide="ignore"):
        logs = np.log(by_order)
    value = np.where(by_order[0] > 0, logs[0], cut) - np.log(others) + (longest - 1) * cut
    for n in range(2, p.order + 1):
        seen = np.flatnonzero(by_order[n - 1] > 0)
        value[seen] = logs[n - 1][seen] - logs[n - 2][seen - 1] + (longest[seen] - n) * cut
    added = np.bincount(text, value, len(sizes))
    return np.divide(added, sizes, out=np.full(len(sizes), np.nan), where=sizes > 0)


def score(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words and lm_score, the mean natural log of a word's score, for every row of ``docs`` (doc_id, text).

    Copies of a text are other documents to each other. A text without words, or a null one, has
    no score and adds nothing; a row without id is scored as any other. In an empty corpus there
    is nothing to score. Words and n-grams are told apart by 64-bit hashes.
    """
    made = chunks(docs, p)
    total = made.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    known = reduce(DataFrame.unionByName, [sums(made, which, total, p) for which in range(p.slices)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, of = [], {}
        for which in set(right.column("slice").to_pylist()):
            some = right.filter(pc.equal(right.column("slice"), which))
            of[which] = tuple(pc.list_flatten(some.column(c)).to_numpy() for c in ("places", "totals"))
        for batch in left.to_batches():
            for words, sizes, ids in zip(_lists(batch.column("words")), _lists(batch.column("sizes")), batch.column("ids"), strict=True):
                found = chunk_scores(words, sizes.astype(np.int64), of, total, p)
                out.append(pa.table({"doc_id": ids.values, "n_words": pa.array(sizes, pa.int64()), "lm_score": pa.array(found, from_pandas=True)}))
        return pa.concat_tables(out) if out else pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("lm_score", pa.float64())]).empty_table()

    part = F.pmod(F.xxhash64("chunk"), F.lit(p.slices))
    scored = [
        settle(made.where(part == k).groupBy("chunk").cogroup(known.where(part == k).groupBy("chunk")).applyInArrow(
            run, "doc_id long, n_words long, lm_score double"), "scores") for k in range(p.slices)]
    return reduce(DataFrame.unionByName, scored).withColumn("lm_score", F.round("lm_score", 6))


def op8_backoff(spark, sf_dir: str) -> DataFrame:
    """Every document scored by word triples, pairs and words of all other documents, none pruned."""
    return score(documents(spark, sf_dir).select("doc_id", "text"))
