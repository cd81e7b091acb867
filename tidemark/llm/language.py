"""Language identification by string kernels.

Two texts are as alike as they share distinct character n-grams of all lengths up to ``most``,
inside words and their borders (the blended spectrum, presence only), over the root of the product of their numbers. Some
training texts are landmarks: kernel values against them, turned by the inverse root of the
landmarks' own kernel matrix (Nyström), are the features of one ridge regression per language.
Texts are scored some dozens at a time: presence matrix by landmark matrix by coefficients.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, held_out, small
from tidemark.llm.grams import Block, blocks

LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """At most ``sample_rows`` texts are learned from, as many of each language (``least_rows`` where
    languages are many); of a longer text, a window of ``sample_chars`` code points."""

    sample_rows: int = 1200
    least_rows: int = 5
    sample_chars: int = 4000
    landmarks: int = 96
    most: int = 4
    bits: int = 20  # of an n-gram's hash
    ridge: float = 1e-3
    together: int = 64  # texts in one matrix product


@dataclass(frozen=True)
class Model:
    """``columns``: the n-grams of the landmarks; ``marks``: which landmark holds which; ``weights``: by landmark and language."""

    columns: np.ndarray
    marks: np.ndarray
    weights: np.ndarray
    languages: tuple[str, ...]


def _grams(pieces: list[str], p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: hashes of the n-grams in words and their borders, and the piece each belongs to."""
    block = Block([piece.lower() for piece in pieces])
    owner = np.repeat(np.arange(block.count), np.diff(np.append(block.starts, len(block.codes))))
    for n, hashes in block.ngrams(p.most):
        places = np.flatnonzero(block.inside_words(n))
        yield hashes[places] >> np.uint64(64 - p.bits), owner[places]


def presence(texts: Sequence[str | None], columns: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """One row per text, one column per n-gram of ``columns``: 1 where the text holds it; and each text's number of distinct n-grams."""
    place = np.full(1 << p.bits, len(columns), np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    out, sizes, long = np.zeros((len(texts), len(columns) + 1), np.float32), np.zeros(len(texts), np.int64), {}
    for rows, pieces in blocks(texts):
        index = np.asarray(rows)
        found = []
        for hashes, owner in _grams(pieces, p):
            out[index[owner], place[hashes]] = 1
            found.append((owner.astype(np.uint64) << np.uint64(p.bits)) | hashes)
        every = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        every = every[np.append(True, every[1:] != every[:-1])] if len(every) else every
        owner = (every >> np.uint64(p.bits)).astype(np.int64)
        counts = np.bincount(owner, minlength=len(rows))
        for k in {0, len(rows) - 1}:  # only these may be pieces of a longer text
            if len(pieces[k]) < len(texts[rows[k]] or ""):
                seen = long.setdefault(rows[k], np.zeros(1 << p.bits, bool))
                seen[every[owner == k] & np.uint64((1 << p.bits) - 1)] = True
        sizes[index] = counts
    for row, seen in long.items():
        sizes[row] = seen.sum()
    return out[:, :-1], sizes


def kernel(held: np.ndarray, sizes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Shared n-grams of texts (rows of ``held``) and landmarks, over the root of the product of all that either has."""
    root = np.sqrt(np.maximum(sizes, 1)).astype(np.float32)[:, None] * np.sqrt(np.maximum(marks.sum(axis=1), 1))
    return (held @ marks.T) / root


def fit(texts: list[str], languages: list[str], p: Params) -> Model:
    """Landmarks are taken from the languages in turn, in the order of the texts given."""
    names = tuple(sorted(map(str, set(languages))))
    by_name = {n: [t for t, l in zip(texts, languages, strict=True) if l == n] for n in names}
    turns = [by_name[n][k] for k in range(max(map(len, by_name.values()), default=0)) for n in names if k < len(by_name[n])]
    chosen = turns[: p.landmarks]
    found = [h for rows, pieces in blocks(chosen) for h, _ in _grams(pieces, p)]
    columns = np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)
    if not names:
        return Model(columns, np.zeros((0, len(columns)), np.float32), np.zeros((0, 0)), names)
    marks, sizes = presence(chosen, columns, p)
    among = kernel(marks, sizes, marks).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    rows = [kernel(*presence(texts[k : k + p.together], columns, p), marks) for k in range(0, len(texts), p.together)]
    features = np.concatenate(rows).astype(np.float64) @ root
    goal = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    gram = features.T @ features + p.ridge * len(texts) * np.eye(features.shape[1])
    return Model(columns, marks, root @ np.linalg.solve(gram, features.T @ goal), names)


def predict(texts: Sequence[str | None], model: Model, p: Params) -> tuple[list[str], np.ndarray]:
    """The language of each text and how sure that is (0 to 1): the ridge's value, from -1..1, cut to 0..1."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if isinstance(t, str) and LETTER.search(t)] if model.languages else []
    for at in range(0, len(known), p.together):
        some = known[at : at + p.together]
        values = kernel(*presence([texts[k] for k in some], model.columns, p), model.marks) @ model.weights
        best = values.argmax(axis=1)
        for row, k in enumerate(some):
            names[k] = model.languages[int(best[row])]
            scores[k] = min(1.0, max(0.0, (values[row, best[row]] + 1) / 2))
    return names, scores


def training_sample(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, text, lang of as many texts of each language; which ones, and where a long one's window lies, depends on ids alone."""
    most = F.greatest(F.length("text") - p.sample_chars, F.lit(0)) + 1
    window = F.substr("text", (F.pmod(F.xxhash64("doc_id", F.lit("window")), most) + 1).cast("int"), F.lit(p.sample_chars))
    usable = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", window.alias("text"), "lang")
    usable = usable.where(F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    each = F.greatest(F.lit(p.least_rows), F.floor(F.lit(p.sample_rows) / F.count("*").over(Window.partitionBy(F.lit(0)))))
    shares = small(counts.select("lang", each.alias("each"), (2 * each / F.col("n")).alias("share")))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    few = usable.join(shares, "lang").where(draw < F.greatest("share", 50 / F.col("each") * F.col("share")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    return few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.col("each")).select("k", "doc_id", "text", "lang")


def train(docs: DataFrame, p: Params = Params()) -> Model:
    """Fitted in one task on the bounded sample."""
    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"k": [], "doc_id": [], "text": [], "lang": []}), *parts]).sort_values(["k", "lang"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(list(rows.text), list(rows.lang), p))]})

    made = training_sample(docs, p).repartition(1).mapInPandas(learn, "model binary").collect()
    return pickle.loads(bytes(made[0].model)) if made else fit([], [], p)


def identify(docs: DataFrame, model: Model, text: str = "text", p: Params = Params()) -> Column:
    """A struct of lang_pred and score for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks' lengths

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = predict(list(texts), shared.value, p)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return of(F.col(text))


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Every document's language; learned from the other folds' texts and languages alone.

    A null text, or one without a letter, is ``und`` with score 0; without labelled texts all are.
    Rows without an id are predicted, not learned from; repeated rows are predicted alike.
    """
    docs = documents(spark, sf_dir)
    model = train(docs.select("doc_id", "text", "lang"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(docs, model).alias("_made")).select(
        "doc_id", "held_out", "_made.*")
