"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs and character
n-grams inside words; a softmax layer over the average gives the classes. Vectors and layer are
trained by stochastic gradient descent in numpy, in one Spark task, on a bounded sample.
Scoring needs no vectors: the layer is linear in the average, so each bucket's vector times the
layer is taken once, and a document's score is the mean of one number per n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, held_out
from tidemark.llm.grams import Block, blocks, mix


@dataclass(frozen=True)
class Params:
    """``sample_rows`` labelled texts are learned from; of a longer one, a window of ``sample_chars`` code points."""

    sample_rows: int = 4000
    sample_chars: int = 20_000
    bits: int = 16  # of the number of buckets
    dim: int = 8
    epochs: int = 4
    rate: float = 1.0
    least: int = 3  # code points of a character n-gram
    most: int = 5
    seed: int = 7


def features(block: Block, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the block (rising) and buckets of the features found there, by kind."""
    shift = np.uint64(64 - p.bits)
    for n, hashes in block.ngrams(p.most):
        if n >= p.least:
            places = np.flatnonzero(block.inside_words(n))
            yield places, (hashes[places] >> shift).astype(np.int64)
    first, words = block.words()
    yield first, (words >> shift).astype(np.int64)
    owner = np.searchsorted(block.starts, first, "right")
    pair = np.flatnonzero(owner[1:] == owner[:-1]) if len(first) > 1 else np.zeros(0, np.int64)
    pairs = mix(words[pair] * np.uint64(3) + words[pair + 1]) if len(pair) else np.zeros(0, np.uint64)
    pairs[words[pair] == words[pair + 1]] = 1  # a word said twice is one feature, whatever the word
    yield first[pair], (pairs >> shift).astype(np.int64)


def bags(texts, p: Params) -> list[np.ndarray]:
    """All buckets of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, pieces in blocks(texts):
        block = Block(pieces)
        for places, buckets in features(block, p):
            bounds = np.append(np.searchsorted(places, block.starts), len(places))
            for k, row in enumerate(rows):
                out[row].append(buckets[bounds[k] : bounds[k + 1]])
    return [np.concatenate(parts) for parts in out]


def fit(texts, labels, p: Params) -> np.ndarray:
    """One number per bucket, then the bias: the log odds of label 1 against label 0.

    Without two classes to tell apart, all numbers are 0 but the bias, which favours the
    class that there is (nothing, if there is none).
    """
    labels = np.asarray(labels, np.int64)
    ones = int(labels.sum())
    if ones in (0, len(labels)):
        return np.append(np.zeros(1 << p.bits), 0.0 if not len(labels) else (3.0 if ones else -3.0)).astype(np.float32)
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1 / p.dim, 1 / p.dim, (1 << p.bits, p.dim))
    layer, bias = np.zeros((p.dim, 2)), np.zeros(2)
    # some texts at a time: a text's distinct buckets are far fewer than its features
    found = [(b.astype(np.int32), c.astype(np.int32)) for at in range(0, len(texts), 64) for b, c in (
        np.unique(bag, return_counts=True) for bag in bags(texts[at : at + 64], p))]
    steps, done = p.epochs * len(found), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(found)):
            buckets, counts = found[i]
            rate, done = p.rate * (1 - done / steps), done + 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            scores = mean @ layer + bias
            odds = np.exp(scores - scores.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            pull = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            vectors[buckets] -= rate * len(buckets) ** 0.5 * np.outer(share, pull)
    return np.append(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]).astype(np.float32)


def predict(texts, weights: np.ndarray, p: Params) -> np.ndarray:
    """The probability of label 1; of a text without words, what the bias says."""
    table, bias = weights[:-1].astype(np.float64), float(weights[-1])
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, pieces in blocks(texts):
        block = Block(pieces)
        for places, buckets in features(block, p):
            np.add.at(total, rows, block.sums(table[buckets], places))
            np.add.at(count, rows, np.diff(np.append(np.searchsorted(places, block.starts), len(places))))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -60, 60)))


def training_sample(docs: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """Text and label of labelled documents outside the held-out fold, at most ``sample_rows``.

    Which are taken, and where a long one's window lies, depends on the id alone. An id with
    several labels has their smallest; labels without a text take up no place.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").cast("int").alias("_label"))
    there = docs.where("text is not null and doc_id is not null").select("doc_id").distinct()
    few = known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample_rows)
    most = F.greatest(F.length("text") - p.sample_chars, F.lit(0)) + 1
    window = F.substr("text", (F.pmod(F.xxhash64("doc_id", F.lit("window")), most) + 1).cast("int"), F.lit(p.sample_chars))
    # sample_rows pairs of numbers at most
    return docs.where("text is not null").join(F.broadcast(few), "doc_id").select("doc_id", window.alias("text"), "_label")


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> np.ndarray:
    """The weights, learned in one task from the bounded sample (its rows at most once each).

    A repeated document id could multiply the sample; so it is bounded once more.
    """
    sample = training_sample(docs, labels, p).orderBy(F.xxhash64("doc_id", "text")).limit(p.sample_rows)

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "_label": []}), *parts])
        rows = rows.sort_values(["doc_id", "text"])
        yield pd.DataFrame({"weights": [fit(list(rows.text), list(rows._label), p).tobytes()]})

    made = sample.coalesce(1).mapInPandas(learn, "weights binary").collect()
    return np.frombuffer(bytes(made[0].weights), np.float32) if made else fit([], [], p)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", p: Params = Params()) -> Column:
    """A column with the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits + 1 numbers

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(predict(list(texts), shared.value, p))

    return of(F.col(text))


THRESHOLD = 0.3


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's score; null and empty texts have the score of the bias."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns as they are."""
    return docs.where(score(docs, train(docs, labels)) >= THRESHOLD)
