"""Raw JSON and CSV scans, and Silver/Gold table scans."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.errors import HeaderMismatch
from medallion.operators.conform import cast_to, check_columns, rename_alternates
from medallion.schemas import (
    ALTERNATE_HEADERS,
    GEN_INFO,
    GOLD,
    READMISSIONS,
    REQUIRED_RAW_MEASURES,
)

_CORRUPT = "_corrupt_record"


def read_gen_info_json(spark: SparkSession, path: str, *, long_key: bool = False) -> DataFrame:
    """Every JSON line below ``path`` under the declared schema; ``long_key`` reads keys as long.

    A malformed line is a row of nulls, a blank line is no row, and a value of the wrong type is
    null. Field names match case-sensitively.
    """
    schema = GEN_INFO
    if long_key:
        wide = T.StructField("provider id", T.LongType())
        schema = T.StructType([wide if f.name == wide.name else f for f in GEN_INFO])
    return spark.read.schema(schema).json(path)


def read_malformed_json(spark: SparkSession, path: str) -> DataFrame:
    """The lines below ``path`` that the declared schema could not take whole: file, line, and what was read of it.

    A line is here if it is no JSON object, or if a value has the wrong type. ``read_gen_info_json`` keeps
    a row for each of them all the same.
    """
    schema = T.StructType([*GEN_INFO, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    kept = lines.select("*", F.col("_metadata.file_path").alias("file"))
    # All columns are asked for: the scan tests only values that it has to read.
    return kept.filter(F.col(_CORRUPT).isNotNull()).select(
        "file", F.col(_CORRUPT).alias("line"), *(f"`{c}`" for c in GEN_INFO.names)
    )


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """The different first lines of the text files below ``path``.

    One pass over the bytes, without parsing; what is shuffled is one row per file. More lines than
    headers can differ in by alternate names are not asked for.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    opening = lines.filter((F.col("start") == 0) & F.col("value").rlike(r"\S"))
    first = opening.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    distinct = first.select("header").distinct().limit((1 << len(ALTERNATE_HEADERS)) + 1)
    return sorted(row["header"] for row in distinct.collect())


def _canonical(header: str) -> list[str]:
    names = next(csv.reader([header], escapechar="\\"), [])
    for old, new in ALTERNATE_HEADERS.items():
        if old in names and new not in names:
            names[names.index(old)] = new
    return names


def read_measures_csv(
    spark: SparkSession,
    path: str,
    *,
    strict: bool = True,
    infer: bool = False,
    cast: bool = True,
    mixed: bool = False,
) -> DataFrame:
    """Every CSV file with a header below ``path``, under canonical names and declared types.

    Values are read as text and then cast, so that a column of digits stays a string where the
    schema says so. ``enforceSchema=false`` makes a file whose header differs from the first one
    fail instead of binding its columns by position. ``strict`` raises when a column that Gold
    needs is absent. ``infer`` takes Spark's inferred types in place of the declared ones; it
    costs one more pass over the data. Without ``cast`` all values stay text.

    ``mixed`` lets files with canonical and with alternate names lie side by side: all headers are read
    first and must be the same under canonical names, else it raises. It costs a pass over the bytes.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    headers = header_lines(spark, path) if mixed and not infer else []
    if len(headers) > 1:
        names = _canonical(headers[0])
        if other := next((h for h in headers if _canonical(h) != names), None):
            raise HeaderMismatch(f"the header {other!r} differs from {headers[0]!r}")
        # The headers have been checked here; the scan need not find the first one in every file.
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = reader.option("enforceSchema", True).schema(schema).csv(path)
    else:
        if infer:
            reader = reader.option("inferSchema", True)
        df = rename_alternates(reader.csv(path), ALTERNATE_HEADERS)
    check_columns(df, READMISSIONS.names, REQUIRED_RAW_MEASURES if strict else [])
    return cast_to(df, READMISSIONS) if cast and not infer else df


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold by path, state first. The explicit schema keeps digit-only partition values text."""
    return spark.read.schema(GOLD).parquet(path).select(*(f"`{c}`" for c in GOLD.names))
