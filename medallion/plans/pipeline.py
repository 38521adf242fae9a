"""Gold publication and the full run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from medallion import catalog
from medallion.errors import EmptyResult, UnknownOption
from medallion.locations import Paths, discard, qualified, subfolders
from medallion.operators.joins import BROADCAST_LIMIT, fits_broadcast
from medallion.plans.gold import gold, usable_facilities
from medallion.plans.silver import build_gen_info, build_readmissions
from medallion.plans.summary import write_summary
from medallion.schemas import GOLD
from medallion.sinks import preview, write_gold, write_snapshot

VERSION = "version-"

STAGES = {
    "full": ("silver", "checks", "gold"),
    "silver": ("silver",),
    "checks": ("checks",),
    "gold": ("gold",),
}


@dataclass
class RunReport:
    """Row counts by dataset or table."""

    rows: dict[str, int] = field(default_factory=dict)


def publish_gold(
    df: DataFrame,
    paths: Paths,
    table: str,
    *,
    dynamic: bool = False,
    show: bool = True,
    single_file: bool = True,
    summary: str | None = None,
) -> int:
    """Write a new version of Gold, show it in the table, write the snapshot. Returns Gold's rows.

    Rows are computed and written once, into a new folder below ``paths.gold``. When that is complete,
    a manifest in it records the place of every state, and one catalog operation moves all partitions
    of the table there: a reader sees the old version or the new one, never a part. An empty result
    raises and leaves table and snapshot as they were. ``dynamic`` replaces the written states and
    keeps the places of the others. A publication that broke off is completed first. Versions that
    neither this publication nor the last one reads are deleted. Count, preview, snapshot
    and, if it has a place, the summary for dashboards come from the table.
    """
    spark = df.sparkSession
    folder = f"{paths.gold}/{VERSION}{uuid.uuid4().hex}"
    write_gold(df, folder)
    states = catalog.partition_folders(spark, folder)
    if not states:
        discard(spark, folder)
        raise EmptyResult("the Gold result has no row; the old one stays")
    catalog.complete_publication(spark, table)
    last = catalog.table_location(spark, table)
    shown = catalog.read_manifest(spark, table)
    if dynamic:
        states = {**shown, **states}
    catalog.write_manifest(spark, folder, states)
    catalog.show_manifest(spark, table, folder)
    read = {qualified(spark, place.rsplit("/", 1)[0]) for place in [*shown.values(), *states.values()]}
    for old in subfolders(spark, paths.gold):
        named = old.rsplit("/", 1)[1].startswith(VERSION)
        if named and qualified(spark, old) not in (*read, last, qualified(spark, folder)):
            discard(spark, old)
    written = read_published(spark, table)
    rows = written.count()
    if show:
        preview(written)
    write_snapshot(written, paths.snapshot, single_file=single_file)
    if summary is not None:
        write_summary(written, summary)
    return rows


def read_published(spark: SparkSession, table: str) -> DataFrame:
    """The Gold table as it is now, columns in Gold's order."""
    return catalog.read_table(spark, table).select(*(f"`{c}`" for c in GOLD.names))


def build_gold(
    readmissions: DataFrame,
    gen_info: DataFrame,
    paths: Paths,
    table: str,
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
    **publish_options,
) -> int:
    """The Gold transform and its publication; the facility side is measured once."""
    fits = fits_broadcast(usable_facilities(gen_info), broadcast_limit)
    return publish_gold(
        gold(readmissions, gen_info, broadcast=fits), paths, table, **publish_options
    )


def run(
    spark: SparkSession,
    paths: Paths,
    stage: str = "full",
    *,
    database: str = catalog.DATABASE,
    strict: bool = True,
    dynamic: bool = False,
    show: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT,
    single_file: bool = True,
    move_tables: bool = False,
    summary: str | None = None,
) -> RunReport:
    """Run a stage, or all of them in order; the first error stops the run.

    The stages that write declare the tables first; tables at another location raise, or move to
    ``paths`` with ``move_tables``. The checks do not, so that they fail on tables nobody has
    made. ``strict`` also raises on keys that do not fit the declared type.
    """
    if stage not in STAGES:
        raise UnknownOption(f"stage {stage!r}, allowed: {list(STAGES)}")
    gen_info = f"`{database}`.`{catalog.GEN_INFO_TABLE}`"
    readmissions = f"`{database}`.`{catalog.READMISSIONS_TABLE}`"
    gold_table = f"`{database}`.`{catalog.GOLD_TABLE}`"
    report = RunReport()
    for step in STAGES[stage]:
        if step != "checks":
            catalog.create_tables(spark, paths, database, move=move_tables)
        if step == "silver":
            report.rows["gen_info"] = build_gen_info(
                spark, paths.gen_info_raw, paths.gen_info, strict=strict
            )
            report.rows["readmissions"] = build_readmissions(
                spark, paths.readmissions_raw, paths.readmissions, strict=strict
            )
        elif step == "checks":
            report.rows.update(catalog.check_tables(spark, [gen_info, readmissions]))
        else:
            report.rows["gold"] = build_gold(
                catalog.read_table(spark, readmissions),
                catalog.read_table(spark, gen_info),
                paths,
                gold_table,
                broadcast_limit=broadcast_limit,
                dynamic=dynamic,
                show=show,
                single_file=single_file,
                summary=summary,
            )
    return report
