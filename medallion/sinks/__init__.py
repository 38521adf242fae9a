"""Parquet and CSV writers."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.locations import (
    can_join_files,
    discard,
    file_states,
    join_files,
    replace_folder,
    write_text,
)
from medallion.schemas import PARTITION_COLUMN
from medallion.sources.snapshot import write_record


def write_silver(df: DataFrame, path: str) -> None:
    """Replace a Silver dataset; as many files as the plan has tasks."""
    df.write.mode("overwrite").parquet(path)


def write_gold(df: DataFrame, path: str, *, dynamic: bool = False) -> None:
    """Replace Gold, one directory per state.

    Rows are first rebalanced by state, so a state is written by few tasks and into few files,
    and the adaptive engine splits a state that is too large for one task. Without adaptive
    execution a shuffle by state could not be split, so none is made. ``dynamic`` keeps the
    states that are not in ``df``.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        df = df.hint("rebalance", PARTITION_COLUMN)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )


def write_snapshot(
    df: DataFrame, path: str, *, single_file: bool = True, log: str | None = None
) -> None:
    """Replace the CSV snapshot: one file with a header, or one per task if the caller says so.

    A single file is written in parallel parts that the file system joins behind the header. Where it
    cannot join files (``can_join_files``), all rows pass through one task; the number of rows
    never decides. Blanks around values are kept. A record next to the files says which they are and
    whether a value holds a line break, as only then must a reader take a file whole. ``log`` is a
    folder above that keeps the record of its newest snapshot, so that no reader lists the older ones.
    """
    spark = df.sparkSession
    breaks = Observation()
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    broken = reduce(or_, (F.col(f"`{c}`").rlike(r"[\r\n]") for c in texts), F.lit(False))
    df = df.observe(breaks, F.coalesce(F.bool_or(broken), F.lit(False)).alias("line_breaks"))
    if single_file and can_join_files(spark, path):
        _write_joined(df, path.rstrip("/"))
    elif single_file:
        _csv_writer(df.coalesce(1), header=True).option("maxRecordsPerFile", 0).csv(path)
    else:
        _csv_writer(df, header=True).csv(path)
    write_record(spark, path, breaks.get["line_breaks"], df.columns, log)


def _csv_writer(df: DataFrame, *, header: bool) -> DataFrameWriter:
    writer = df.write.mode("overwrite").option("header", header)
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    return writer


def _write_joined(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    above, name = path.rsplit("/", 1) if "/" in path else (".", path)
    write_id = uuid.uuid4()
    # A hidden name: readers of the folders above do not see it.
    work = f"{above}/_{name}-{write_id}"
    try:
        names = spark.createDataFrame([df.columns], ", ".join(f"c{k} string" for k in range(len(df.columns))))
        _csv_writer(names.coalesce(1), header=False).csv(f"{work}/header")
        # Joined in the end, a task's rows go to one part, whatever the session's limit of records a file.
        _csv_writer(df, header=False).option("maxRecordsPerFile", 0).csv(f"{work}/parts")
        parts = [
            f"{work}/{part}/{file}"
            for part in ("header", "parts")
            for file, (length, _) in sorted(file_states(spark, f"{work}/{part}").items())
            if file.endswith(".csv") and length
        ]
        join_files(spark, parts, f"{work}/whole/part-00000-{write_id}-c000.csv")
        write_text(spark, f"{work}/whole/_SUCCESS", "")
        replace_folder(spark, f"{work}/whole", path)
    finally:
        discard(spark, work)


def first_rows(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows in the order of all columns, left to right."""
    return df.orderBy(*(f"`{c}`" for c in df.columns)).limit(rows)


def preview(df: DataFrame, rows: int = 10) -> None:
    """Print the first rows in full width."""
    df.show(rows, truncate=False)
