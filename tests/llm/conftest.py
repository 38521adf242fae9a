from __future__ import annotations

import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def frame(spark, tmp_path):
    """A stored table, several files of it, of rows of the given columns."""
    made = []

    def make(rows, schema="doc_id long, text string", parts=3):
        folder = str(tmp_path / f"t{len(made)}")
        made.append(folder)
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(folder)
        return spark.read.schema(schema).parquet(folder)

    return make
