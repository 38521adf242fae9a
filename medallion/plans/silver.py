"""Raw to Silver jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.errors import LostKeys
from medallion.operators.conform import cast_to, require_rows
from medallion.schemas import GEN_INFO, READMISSIONS
from medallion.sinks import write_silver
from medallion.sources.raw import (
    read_gen_info_json,
    read_malformed_json,
    read_measures_csv,
)


def build_gen_info(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    strict: bool = True,
    quarantine: str | None = None,
) -> int:
    """Facility JSON to Silver; raises on an empty source. Returns the number of rows.

    ``quarantine`` is a place for the lines that the schema could not take whole, with their files; they
    count as rows of Silver all the same. Numbers too large for the declared key are counted during the write; ``strict`` raises on them.
    """
    raw = require_rows(read_gen_info_json(spark, source, long_key=True), source)
    if quarantine is not None:
        write_silver(read_malformed_json(spark, source), quarantine)
    _write(raw, GEN_INFO, F.col("`provider id`").isNotNull(), target, strict)
    return _rows(spark, target)


def build_readmissions(
    spark: SparkSession, source: str, target: str, *, strict: bool = True, mixed: bool = True
) -> int:
    """Measure CSV to Silver under canonical names. Returns the number of rows.

    ``mixed`` takes files with canonical and alternate names in one folder, for a pass over the bytes.
    Keys of digits that do not fit the declared type are counted during the write; ``strict``
    raises on them.
    """
    raw = read_measures_csv(spark, source, strict=strict, cast=False, mixed=mixed)
    if "Provider ID" in raw.columns:
        has_key = F.col("`Provider ID`").rlike(r"^\s*[+-]?[0-9]+\s*$")
    else:
        has_key = F.lit(False)
    _write(raw, READMISSIONS, has_key, target, strict)
    return _rows(spark, target)


def _write(raw: DataFrame, schema, has_key: Column, target: str, strict: bool) -> None:
    key = next((c for c in raw.columns if c.lower() == "provider id"), None)
    lost = Observation()
    fits = F.col(f"`{key}`").try_cast(schema[key].dataType).isNotNull() if key else F.lit(True)
    counted = raw.observe(lost, F.count_if(has_key & ~fits).alias("n"))
    write_silver(cast_to(counted, schema), target)
    if strict and lost.get["n"]:
        raise LostKeys(f"{lost.get['n']} keys do not fit {schema[key].dataType.simpleString()}")


def _rows(spark: SparkSession, path: str) -> int:
    # Parquet footers hold it; counting the raw text would parse it a second time.
    return spark.read.parquet(path).count()
