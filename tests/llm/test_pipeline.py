"""The registered queries next to their SQL, and the pipeline's stages."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from clientbook.llm import queries
from verification.compare import duck, rows_of

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = queries.queries()[name](spark, DATA)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck(DATA).execute(queries.oracle_sql()[name])
    assert ours == rows_of([d[0] for d in result.description], result.fetchall())


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "bpe":
            assert docs.columns == columns
        if name in ("toxicity", "quality", "near_duplicates"):
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
