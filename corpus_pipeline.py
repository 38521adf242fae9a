"""From raw documents to packed token sequences: the training-data stages in their order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that becomes the next stage's docs; all
but the last return the columns of documents. Stages work on every row they are given; null and empty
texts, repeated rows and empty tables pass through each of them (see the operators for their results).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontamination, near_dups, packing, pii, toxicity
from medallion.llm.frames import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the cut by the convolutional classifier."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.CUT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id."""
    rows = stored(docs.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    found = near_dups.near_duplicates(rows, near_dups.Similarity(words=5, percent=80))
    return rows.join(found.where(~F.col("first_row")).select("uid"), "uid", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    hit = found.select(F.col("doc_id").alias("hit")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("hit")), "left_anti")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for each identifier; n_chars follows the text."""
    changed = pii.find_pii(docs, redacted=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", length)
    return changed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dups", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack),
]

#: Classifier, MinHash and tokenizer have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
