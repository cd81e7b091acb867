"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

import corpus_pipeline
import pytest
from compare import connection, differences
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    want = connection(SMALL).execute(ORACLE[name])
    assert differences(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in want.description], want.fetchall()) == []


def test_held_out_rows_are_told_apart(spark):
    """On a fold that nothing was learned from, nearly all languages and qualities are right."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = QUERIES["op1_language"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out and lang is not null")
    right = found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95
    judged = QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    assert judged.select(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()[0] > 0.9


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        path = corpus_pipeline.new_path(spark, f"test-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and (ids is None or now <= ids)
        ids = now
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "private_data", "mixing", "encoding"]
    assert corpus_pipeline.run(spark, SMALL).select("doc_id", "ids_sha256").exceptAll(last.select("doc_id", "ids_sha256")).count() == 0
