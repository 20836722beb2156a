"""The pipeline's rows against its stages applied one by one, and the promises of each stage."""

from __future__ import annotations

import corpus_pipeline
from shelfstream.llm import weighted_minhash
from shelfstream.llm.oracles import SQL
from shelfstream.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR).cache()
        assert after.columns == docs.columns, name
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "near_copies":
            classes = weighted_minhash.classes(after).collect()
            assert all(r.doc_id == r.class_id for r in classes)
        kept = after
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in kept.select("doc_id").collect())


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert all(any(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11))
