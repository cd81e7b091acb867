"""A training corpus from raw documents: stage after stage, each over all that is left.

``documents`` goes in; out come the token ids of the mixed corpus. Each stage reads what the one
before it wrote. The SQL of the whole is left out: learned weights, keyed surrogates and the
tokenizer cannot be stated in SQL, so tests compare the stages with plain code instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.mixing import repeat_to_mix
from tidemark.llm.neardup import keep_one
from tidemark.llm.pii import with_surrogates
from tidemark.llm.quality import keep_good
from tidemark.llm.tokens import encoded
from tidemark.session import new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on ``labels``, accepts; null and empty texts by the bias alone."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8."""
    return keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` is that of the new text."""
    return with_surrogates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight has them."""
    return repeat_to_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, with digests of the ids and of what they decode to; none of a null text."""
    return encoded(docs.select("doc_id", "source", "lang", "text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mixing", mixing),
    ("encoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
