"""Schema conformance: names, presence, types, non-empty input."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.errors import EmptyInput, MissingColumns


def rename_alternates(df: DataFrame, alternates: dict[str, str]) -> DataFrame:
    """Rename an alternate column to its canonical name unless that name is already there."""
    names = list(df.columns)
    for old, new in alternates.items():
        if old in names and new not in names:
            names[names.index(old)] = new
    return df.toDF(*names) if names != df.columns else df


def check_columns(df: DataFrame, expected: list[str], required: list[str]) -> list[str]:
    """List the expected columns that are absent; raise if a required one is among them."""
    absent = [c for c in expected if c not in df.columns]
    needed = [c for c in absent if c in required]
    if needed:
        raise MissingColumns(needed)
    if absent:
        warnings.warn(f"missing expected columns: {', '.join(absent)}", stacklevel=2)
    return absent


def require_columns(df: DataFrame, *columns: str) -> None:
    """Raise unless every named column exists."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumns(absent)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast declared columns to their types; a value that does not fit becomes null.

    Columns outside the schema stay as they are.
    """
    declared = {f.name: f.dataType for f in schema}
    return df.select(
        *(
            F.col(f"`{c}`").try_cast(declared[c]).alias(c) if c in declared else F.col(f"`{c}`")
            for c in df.columns
        )
    )


def require_rows(df: DataFrame, source: str) -> DataFrame:
    """Raise if the frame has no row; Spark stops reading at the first one."""
    if df.isEmpty():
        raise EmptyInput(f"no records found at {source}")
    return df
