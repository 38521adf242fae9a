from __future__ import annotations

import pytest
from corpora import ODD

import corpus_pipeline
from medallion.llm import queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_the_columns_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        before, after = docs.count(), out.count()
        assert after <= before and (name != "pii" or after == before) and after > before * 0.8
        docs = corpus_pipeline.stored(out, name)
    assert docs.where("text rlike '@[A-Za-z0-9-]+[.]'").isEmpty()
    assert docs.where("n_chars <> length(text)").isEmpty()
    assert docs.dropDuplicates(["text"]).count() == docs.count()
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("rows", [[], [(n, t, None, "s", None) for n, t in enumerate(ODD)] + [(1, "", None, "s", 0)] * 2 + [(None, None, None, None, None)]])
def test_stages_take_odd_documents(spark, frame, rows):
    folder = "/root/testdata/sf0.001"
    docs = frame(rows, COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
    assert (docs.count() > 0) == bool(rows)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
