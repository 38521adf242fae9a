"""Discovery and scan of the newest CSV snapshot."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.locations import file_states, qualified, read_text, subfolders, write_text
from medallion.schemas import GOLD

#: The record of a snapshot, in its folder and in that of a log; the name hides it from scans.
RECORD = "_snapshot.json"

# Spark names all files of one write part-<task>-<write id>-c<n>.csv.
_PART_FILE = re.compile(r"part-\d+-([0-9a-f-]{36})(?:-c\d+)?(\..*)")


@dataclass(frozen=True)
class Snapshot:
    """The newest snapshot: its rows, the newest file and its time; both null where there is none."""

    rows: DataFrame
    path: str | None
    last_updated: str | None


def write_record(
    spark: SparkSession, path: str, line_breaks: bool, columns: list[str], log: str | None = None
) -> None:
    """Record the snapshot in ``path``: its files, their newest, its header, and whether values hold line breaks."""
    files = file_states(spark, path)
    written = [n for n in files if _PART_FILE.fullmatch(n)]
    if not written:
        return
    newest = max(written, key=lambda n: (files[n][1], n))
    record = {
        "folder": qualified(spark, path),
        "newest": newest,
        "length": files[newest][0],
        "changed": files[newest][1],
        "line_breaks": line_breaks,
        "columns": columns,
    }
    for place in {path.rstrip("/"), (log or path).rstrip("/")}:
        write_text(spark, f"{place}/{RECORD}", json.dumps(record))


def read_record(spark: SparkSession, folder: str) -> dict | None:
    """The record in ``folder``, if the file it names is still there as it was."""
    text = read_text(spark, f"{folder.rstrip('/')}/{RECORD}")
    try:
        record = json.loads(text) if text else None
    except ValueError:
        return None
    if record is None:
        return None
    state = file_states(spark, record["folder"]).get(record["newest"])
    return record if state == (record["length"], record["changed"]) else None


def latest_csv(spark: SparkSession, folder: str) -> DataFrame:
    """One row (path, modified) of the newest non-empty CSV file at any depth below ``folder``.

    Both are null when there is none. A folder with a record is not listed: the record names its newest
    snapshot. Only file listings are read, never contents; among equally new files the path decides.
    """
    record = read_record(spark, folder)
    place, names, deep = folder, "*.csv", True
    if record is not None:
        place, names = _files_of(spark, record["folder"], record["newest"])
        names, deep = names if names.endswith(".csv") else "*.csv", False
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", names)
        .option("recursiveFileLookup", deep)
        .load(place)
        .filter("length > 0")
        .agg(F.max(F.struct(F.col("modificationTime").alias("modified"), "path")).alias("newest"))
        .select("newest.path", "newest.modified")
    )


def snapshot_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """``latest_csv`` with its time as text in UTC: (path, last_updated)."""
    last_updated = utc_label(F.col("modified")).alias("last_updated")
    return latest_csv(spark, folder).select("path", last_updated)


def utc_label(time: Column) -> Column:
    """``2025-08-27 14:05 UTC``, whatever the session time zone is."""
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd HH:mm 'UTC'")


def read_latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the newest snapshot below ``folder``; no rows when there is none."""
    return load_latest_snapshot(spark, folder).rows


def load_latest_snapshot(spark: SparkSession, folder: str) -> Snapshot:
    """The newest snapshot below ``folder`` with its path and time, all from one listing.

    A snapshot may have several files, of one task as well. They share the write id in their
    names, so the whole write is read, not the newest file alone. Where its record says that no value
    holds a line break, files are split among tasks. Where values do, files larger than a split are
    read by lines (``_rows_of_lines``). Elsewhere a file is one task.
    """
    newest = snapshot_provenance(spark, folder).first()
    if newest["path"] is None:
        return Snapshot(spark.createDataFrame([], GOLD), None, None)
    parent, name = newest["path"].rsplit("/", 1)
    record = read_record(spark, parent)
    recorded = record is not None and _write_id(record["newest"]) == _write_id(name)
    whole = not recorded or record["line_breaks"]
    place, names = _files_of(spark, parent, name)
    if recorded and whole and record.get("columns") == GOLD.names and _exceeds_split(spark, parent, name):
        rows = _rows_of_lines(spark, place, names)
        return Snapshot(rows, newest["path"], newest["last_updated"])
    rows = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", whole)
        .option("pathGlobFilter", names)
        .schema(GOLD)
        .csv(place)
    )
    return Snapshot(rows, newest["path"], newest["last_updated"])


def _exceeds_split(spark: SparkSession, parent: str, name: str) -> bool:
    """Whether a file of the write that ``name`` belongs to is larger than what one task is meant to read."""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    states = file_states(spark, parent).items()
    return any(length > split for n, (length, _) in states if _write_id(n) == _write_id(name))


def _rows_of_lines(spark: SparkSession, place: str, names: str) -> DataFrame:
    """Rows of CSV files that ``write_snapshot`` wrote, whose values may hold line breaks.

    Files are split into lines among tasks. The writer puts a backslash before each quote and backslash
    of a quoted value, so a line starts a record where the other quotes before it are even in number.
    They are counted by block first; then each block joins its lines to records, and what lies across
    blocks is joined last. Every record goes through the parser of a file that is read whole.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    escaped = F.length("bare") - F.length(F.replace("bare", F.lit('"')))
    lines = (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", names)
        .text(place)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("line"),
        )
        # Only a line with a quote needs the search for those behind a backslash.
        .withColumn("bare", F.when(quotes > 0, F.regexp_replace("line", r"(?s)\\.", "")).otherwise(""))
        .select("file", "block", "at", "line", (escaped % 2).alias("odd"))
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    inside = inside.select("file", "block", F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"))
    # One row for every block: small, whatever the files hold.
    placed = lines.join(F.broadcast(inside), ["file", "block"])
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    starts = (F.col("before") + F.sum("odd").over(so_far) - F.col("odd")) % 2 == 0
    placed = placed.select("file", "block", "at", "line", starts.cast("long").alias("starts"))
    placed = placed.select("file", "block", "at", "line", F.sum("starts").over(so_far).alias("record"))
    pieces = placed.groupBy("file", "block", "record").agg(_joined(F.struct("at", "line")).alias("line"))
    # A block's record 0 is the rest of the last one that starts in an earlier block.
    edges = placed.groupBy("file", "block").agg(F.max("record").alias("last"))
    own = F.when(F.col("last") > 0, F.struct("block", F.col("last").alias("record")))
    edges = edges.select("file", "block", F.last(own, ignorenulls=True).over(earlier).alias("of"))
    pieces = pieces.join(F.broadcast(edges), ["file", "block"])
    rest = F.col("record") == 0
    pieces = pieces.select(
        "file",
        F.when(rest, F.col("of.block")).otherwise(F.col("block")).alias("start"),
        F.when(rest, F.col("of.record")).otherwise(F.col("record")).alias("record"),
        F.struct("block", "line").alias("piece"),
    )
    records = pieces.groupBy("file", "start", "record").agg(_joined(F.col("piece")).alias("line"))
    # The first record of a file is its header.
    records = records.where((F.col("start") > 0) | (F.col("record") > 1))
    options = {"multiLine": "true", "lineSep": "\n"}
    return records.select(F.from_csv("line", GOLD.toDDL(), options).alias("row")).select("row.*")


def _joined(parts: Column) -> Column:
    """The lines of a group in their order, with the line breaks between them."""
    return F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(parts)), lambda part: part["line"]))


def _write_id(name: str) -> str | None:
    part = _PART_FILE.fullmatch(name)
    return part[1] if part else None


def _files_of(spark: SparkSession, parent: str, name: str) -> tuple[str, str]:
    """A path and a pattern of names that give all files of the write that ``name`` belongs to.

    The path is the folder, which is listed in one call; a pattern of its files would have Spark look up
    every single file in a task of its own. Only a folder with others in it takes the pattern as path.
    """
    part = _PART_FILE.fullmatch(name)
    pattern = f"part-*-{part[1]}*{_literal(part[2])}" if part else _literal(name)
    if part and not subfolders(spark, parent):
        return _literal(parent), pattern
    return f"{_literal(parent)}/{pattern}", "*" if part is None else pattern


def _literal(path: str) -> str:
    """Escape the characters that have a meaning in a Hadoop path pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
