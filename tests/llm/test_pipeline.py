import os

import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DATA).toPandas(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    ids = {r.doc_id for r in docs.collect()}
    out = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == ids
