"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import (
    centroids,
    decontamination,
    langid,
    licenses,
    near_dups,
    oracle,
    packing,
    pii,
    prefix_trie,
    quality,
    secrets,
    simple8b,
    toxicity,
    url_filter,
)
from medallion.llm.frames import is_held_out, table
from medallion.locations import scratch_folder

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", ["doc_id", "text", *columns])


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(documents(spark, sf_dir)))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir)))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(documents(spark, sf_dir), near_dups.Similarity(words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def op8_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "simple8b")
    simple8b.write_ids(documents(spark, sf_dir), path, public_tokenizers.path(BYTE_BPE))
    return simple8b.read_ids(spark.read.parquet(path))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    model = langid.fit(docs, public_tokenizers.path(PIECES))
    return langid.predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    held_out = is_held_out()
    predicted = (F.col("score") >= toxicity.CUT).cast("int")
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number of a page's path is the doc_id of its document, whose labels are the page's.

    A page is bad where any label of its document says toxic or of no quality.
    """
    labels = table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]).where("doc_id is not null")
    known = F.max(F.greatest(1 - F.col("quality"), F.col("toxic"))).alias("bad")
    pages = table(spark, sf_dir, "pages", ["page_id", "url"])
    number = F.regexp_extract(url_filter.located("url")[1], "([0-9]+)[^0-9]*$", 1).try_cast("long")
    # Pages without a number would all meet in one task; their page_id keeps them apart.
    numbered = pages.withColumn("doc_id", F.coalesce(number, -F.abs(F.xxhash64("page_id")) - 1))
    labelled = numbered.join(labels.groupBy("doc_id").agg(known), "doc_id", "left")
    return url_filter.judge(labelled).select("page_id", "host", "path", "rule", "verdict")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: value for name, value in globals().items() if name.startswith("op") and callable(value)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
