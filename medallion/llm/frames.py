"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import medallion
from medallion.llm.workers import tidy
from medallion.locations import scratch_folder

_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function that uses this package, which the executors need not have installed."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(medallion.__file__).parent
        archive = os.path.join(tempfile.mkdtemp(prefix="medallion-code-"), "medallion_code.zip")
        with zipfile.ZipFile(archive, "w") as target:
            for source in sorted(root.rglob("*.py")):
                target.write(source, source.relative_to(root.parent))
        context.addPyFile(os.path.realpath(archive))
        _shipped.add(context.applicationId)
    return df.mapInArrow(tidy(function), schema)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as a table in the shared folder, and read again: it survives lost executors."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled(group: str, shares: dict, doc_id: str = "doc_id") -> Column:
    """Whether a hash of the id picks a row, at the share of its group (1 or more: every row)."""
    share = F.lit(0.0)
    for value, part in shares.items():
        share = F.when(F.col(group) == value, F.lit(float(part))).otherwise(share)
    return F.pmod(F.xxhash64(doc_id), F.lit(1_000_003)) < share * 1_000_003
