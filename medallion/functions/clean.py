"""Null, recode and numeric expressions shared by the plans."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.schemas import SENTINEL


def null_sentinel(
    df: DataFrame, columns: list[str] | None = None, sentinel: str = SENTINEL
) -> DataFrame:
    """Turn the sentinel text into null (exact match) in the given or in all string columns."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(_col(c), F.lit(sentinel)) for c in columns})


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which all the columns are non-null.

    One conjunct per column, so that Catalyst can push each to its own join side and scan, and
    turn an outer join below into an inner one. ``dropna`` is a single predicate over all columns
    and does neither.
    """
    return df.filter(reduce(and_, (_col(c).isNotNull() for c in columns)))


def require_present(df: DataFrame, columns: list[str], sentinel: str = SENTINEL) -> DataFrame:
    """``require`` after ``null_sentinel``, stated on the raw columns to reach the scan."""
    present = (_col(c).isNotNull() & (_col(c) != sentinel) for c in columns)
    return df.filter(reduce(and_, present))


def recode(df: DataFrame, mappings: dict[str, dict[str, str]]) -> DataFrame:
    """Replace mapped values of the given columns in one pass; other values and null stay."""
    for column, mapping in mappings.items():
        df = df.replace(mapping, subset=[column])
    return df


def key_as_long(column: str) -> Column:
    """The join key; text that is no number becomes null."""
    return _col(column).try_cast("long")


def rate_diff(predicted: str, expected: str) -> Column:
    """Difference of two rates: computed in float, kept as double, null if either is no number."""
    difference = _col(predicted).try_cast("float") - _col(expected).try_cast("float")
    return difference.cast("double")


def metric_value(column: str) -> Column:
    """A metric as double; text that is no number, and NaN, count as null."""
    return F.nanvl(_col(column).try_cast("double"), F.lit(None).cast("double"))


def kpi_label(value: Column) -> Column:
    """Two decimals of the exact binary value, ``N/A`` for null, the text itself if no number."""
    number = value.try_cast("double")
    return (
        F.when(value.isNull() | F.isnan(number), F.lit("N/A"))
        .when(number.isNotNull(), F.call_function("format_number", number, F.lit("0.00")))
        .otherwise(value.cast("string"))
    )


def _col(name: str) -> Column:
    return F.col(f"`{name}`")
