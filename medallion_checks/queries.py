"""Registered queries: each reads the given tables and returns a lazy frame."""

from __future__ import annotations

import threading
from contextlib import contextmanager, suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import catalog
from medallion.errors import EmptyResult, LostKeys
from medallion.functions import clean
from medallion.locations import Paths, discard, scratch_folder
from medallion.operators import metrics
from medallion.operators.histogram import histogram
from medallion.plans.dashboard import dashboard, snapshot_dashboard
from medallion.plans.gold import (
    KEY,
    gold,
    labelled,
    merged,
    project_facility,
    project_measures,
)
from medallion.plans.pipeline import publish_gold, read_published, run
from medallion.plans.silver import build_gen_info, build_readmissions
from medallion.plans.summary import read_summary, write_summary
from medallion.schemas import (
    ALTERNATE_HEADERS,
    OWNERSHIPS,
    RATINGS,
    READM_TYPES,
    READMISSIONS,
    REQUIRED_COLUMNS,
)
from medallion.sinks import first_rows, write_gold, write_silver, write_snapshot
from medallion.sources import (
    read_gen_info_json,
    load_latest_snapshot,
    read_gold,
    read_latest_snapshot,
    read_measures_csv,
)
from medallion_checks import inputs
from medallion_checks.oracle import snake

STATES = ["S1", "S7", "S31"]
TYPES = ["AMI", "Heart_Failure"]


def snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(snake(c) for c in df.columns))


_latest: dict[tuple[str, str], str] = {}


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new scratch folder; the one of the last call for the same purpose goes."""
    key = (spark.sparkContext.applicationId, purpose)
    if key in _latest:
        discard(spark, _latest[key])
    _latest[key] = scratch_folder(spark, purpose)
    return _latest[key]


def once_per_application(build):
    """Build a folder of derived data at its first use in a Spark application, then share it."""
    built = {}

    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in built:
            target = scratch_folder(spark, build.__name__.replace("_", "-"))
            build(spark, sf_dir, target)
            built[key] = target
        return built[key]

    return folder


@once_per_application
def raw_json(spark, sf_dir, folder):
    inputs.facilities(spark, sf_dir).write.mode("overwrite").json(folder)


@once_per_application
def raw_csv(spark, sf_dir, folder):
    write_raw_csv(inputs.measures(spark, sf_dir), folder)


@once_per_application
def alternate_csv(spark, sf_dir, folder):
    alternates = {new: old for old, new in ALTERNATE_HEADERS.items()}
    df = inputs.measures(spark, sf_dir)
    write_raw_csv(df.toDF(*(alternates.get(c, c) for c in df.columns)), folder)


@once_per_application
def mixed_csv(spark, sf_dir, folder):
    """Files with canonical and files with alternate names side by side."""
    alternates = {new: old for old, new in ALTERNATE_HEADERS.items()}
    df = inputs.measures(spark, sf_dir)
    odd = F.crc32(F.coalesce("Number of Readmissions", F.lit("")).cast("binary")) % 2 == 1
    write_raw_csv(df.filter(odd), folder)
    other = df.filter(~odd).toDF(*(alternates.get(c, c) for c in df.columns))
    other.write.mode("append").option("header", True).csv(folder)


@once_per_application
def damaged_json(spark, sf_dir, folder):
    """The facilities, and for every thirteenth customer a line that breaks off."""
    whole = inputs.facilities(spark, sf_dir)
    whole.select(F.to_json(F.struct(*(f"`{c}`" for c in whole.columns))).alias("value")).write.mode(
        "overwrite"
    ).text(folder)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 13 = 0")
    broken = F.concat(F.lit('{"provider id": '), "c_custkey", F.lit(', "hospital name": "'), "c_name")
    customers.select(broken.alias("value")).write.mode("append").text(folder)


@once_per_application
def partial_csv(spark, sf_dir, folder):
    write_raw_csv(inputs.measures(spark, sf_dir).drop("State", "Footnote"), folder)


@once_per_application
def silver_facilities(spark, sf_dir, folder):
    write_silver(inputs.facilities(spark, sf_dir), folder)


@once_per_application
def silver_measures(spark, sf_dir, folder):
    write_silver(inputs.measures(spark, sf_dir), folder)


@once_per_application
def published_gold(spark, sf_dir, folder):
    write_gold(derived_gold(spark, sf_dir), folder)


def write_raw_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(inputs.FACILITY_SCHEMA).parquet(silver_facilities(spark, sf_dir))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(inputs.MEASURE_SCHEMA).parquet(silver_measures(spark, sf_dir))


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gold(spark, published_gold(spark, sf_dir))


def derived_gold(spark: SparkSession, sf_dir: str, **join_options) -> DataFrame:
    return gold(measures(spark, sf_dir), facilities(spark, sf_dir), **join_options)


def naive_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform in its plain order: right join, null the sentinel, drop, recode."""
    joined = project_measures(measures(spark, sf_dir)).join(
        project_facility(facilities(spark, sf_dir)), KEY, "right"
    )
    return labelled(clean.null_sentinel(joined).dropna(subset=REQUIRED_COLUMNS))


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_metric", F.round("avg_metric", 6))


# --- sources and sinks ---


def json_scan_facilities(spark, sf_dir):
    return snake_names(read_gen_info_json(spark, raw_json(spark, sf_dir)))


def json_row_count(spark, sf_dir):
    return read_gen_info_json(spark, raw_json(spark, sf_dir)).agg(F.count(F.lit(1)).alias("c"))


def csv_scan_measures(spark, sf_dir):
    return snake_names(read_measures_csv(spark, raw_csv(spark, sf_dir)))


def csv_scan_inferred(spark, sf_dir):
    return snake_names(read_measures_csv(spark, raw_csv(spark, sf_dir), infer=True))


def conform_rename(spark, sf_dir):
    return snake_names(read_measures_csv(spark, alternate_csv(spark, sf_dir)))


def conform_mixed(spark, sf_dir):
    """Silver of a folder whose files have canonical or alternate headers."""
    folder = fresh_folder(spark, "mixed")
    build_readmissions(spark, mixed_csv(spark, sf_dir), folder)
    return snake_names(spark.read.schema(READMISSIONS).parquet(folder))


def json_quarantine(spark, sf_dir):
    """The broken lines in their own table, next to Silver's rows, which still count them."""
    folder = fresh_folder(spark, "quarantine")
    source = damaged_json(spark, sf_dir)
    rows = build_gen_info(spark, source, f"{folder}/silver", quarantine=f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    named = F.col("file").contains("/part-").alias("has_file")
    return lines.select("line", named, F.lit(rows).cast("long").alias("rows"))


def conform_missing_columns(spark, sf_dir):
    return snake_names(read_measures_csv(spark, partial_csv(spark, sf_dir), strict=False))


def parquet_silver_roundtrip(spark, sf_dir):
    folder = fresh_folder(spark, "silver")
    write_silver(inputs.facilities(spark, sf_dir), folder)
    return snake_names(spark.read.schema(inputs.FACILITY_SCHEMA).parquet(folder))


# --- Gold, step by step ---


def rate_diff(spark, sf_dir):
    diff = clean.rate_diff("Pred Readm Rate", "Exp Readm Rate").alias("R Rate Diff")
    df = project_measures(measures(spark, sf_dir))
    return snake_names(df.select("provider_id", "Pred Readm Rate", "Exp Readm Rate", diff))


def derived_merged(spark, sf_dir, **join_options):
    return merged(measures(spark, sf_dir), facilities(spark, sf_dir), **join_options)


def null_sentinel(spark, sf_dir):
    return snake_names(clean.null_sentinel(derived_merged(spark, sf_dir)))


def require_columns(spark, sf_dir):
    df = clean.null_sentinel(derived_merged(spark, sf_dir))
    return snake_names(clean.require(df, REQUIRED_COLUMNS))


def recoded_counts(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    counted = clean.recode(df, {column: mapping}).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return snake_names(counted)


# --- published Gold ---


def gold_partitioned_roundtrip(spark, sf_dir):
    folder = fresh_folder(spark, "gold")
    write_gold(derived_gold(spark, sf_dir), folder)
    return snake_names(read_gold(spark, folder))


def gold_partition_pruned(spark, sf_dir):
    return snake_names(metrics.filter_rows(gold_table(spark, sf_dir), ["S1"]))


_databases: dict[tuple[str, str], str] = {}


def new_database(spark, purpose: str) -> tuple[str, str]:
    """A database and its folder; those of the last call for the same purpose go."""
    key = (spark.sparkContext.applicationId, purpose)
    if key in _databases:
        spark.sql(f"DROP DATABASE IF EXISTS `{_databases[key]}` CASCADE")
    folder = fresh_folder(spark, f"database-{purpose}")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{folder}/db'")
    _databases[key] = name
    return name, folder


def gold_repaired_count(spark, sf_dir):
    database, folder = new_database(spark, "repaired")
    paths = Paths.under(folder)
    catalog.create_tables(spark, paths, database)
    write_gold(derived_gold(spark, sf_dir), paths.gold)
    table = f"`{database}`.`{catalog.GOLD_TABLE}`"
    catalog.repair_partitions(spark, table)
    return catalog.count_rows(spark, table)


def pipeline_paths(spark, sf_dir, folder: str) -> Paths:
    return replace(
        Paths.under(folder),
        gen_info_raw=raw_json(spark, sf_dir),
        readmissions_raw=raw_csv(spark, sf_dir),
    )


def table_checks(spark, sf_dir):
    database, folder = new_database(spark, "checks")
    run(spark, pipeline_paths(spark, sf_dir, folder), "silver", database=database)
    gen_info, readmissions = (
        catalog.count_rows(spark, f"`{database}`.`{table}`").select(
            F.lit(table).alias("table_name"), "c"
        )
        for table in (catalog.GEN_INFO_TABLE, catalog.READMISSIONS_TABLE)
    )
    return gen_info.unionByName(readmissions)


def full_run(spark, sf_dir, **options):
    database, folder = new_database(spark, "full")
    run(spark, pipeline_paths(spark, sf_dir, folder), database=database, show=False, **options)
    return snake_names(read_published(spark, f"`{database}`.`{catalog.GOLD_TABLE}`"))


def full_run_summary(spark, sf_dir):
    """KPIs from the summary that a full run leaves."""
    database, folder = new_database(spark, "summary")
    paths, place = pipeline_paths(spark, sf_dir, folder), f"{folder}/summary"
    run(spark, paths, database=database, show=False, summary=place)
    gold = read_published(spark, f"`{database}`.`{catalog.GOLD_TABLE}`")
    return rounded(dashboard(gold, summary=read_summary(spark, place))["kpis"])


def full_run_shuffled(spark, sf_dir):
    return full_run(spark, sf_dir, broadcast_limit=0)


@once_per_application
def moved_csv(spark, sf_dir, folder):
    state = F.concat(F.lit("T"), "State").alias("State")
    df = inputs.measures(spark, sf_dir)
    write_raw_csv(df.select(*(state if c == "State" else f"`{c}`" for c in df.columns)), folder)


def two_locations(spark, sf_dir):
    """Runs at two places in one database: the tables move, and each place keeps its own Gold."""
    database, folder = new_database(spark, "places")
    table = f"`{database}`.`{catalog.GOLD_TABLE}`"
    both = []
    for place, csv in (("a", raw_csv), ("b", moved_csv)):
        paths = pipeline_paths(spark, sf_dir, f"{folder}/{place}")
        paths = replace(paths, readmissions_raw=csv(spark, sf_dir))
        run(spark, paths, database=database, show=False, move_tables=True)
        gold = read_gold(spark, catalog.table_location(spark, table))
        both.append(gold.withColumn("place", F.lit(place)))
    return snake_names(both[0].unionByName(both[1]))


def empty_gold_keeps_old(spark, sf_dir):
    """The table after a publication without rows: as it was."""
    database, folder = new_database(spark, "empty")
    table = f"`{database}`.`{catalog.GOLD_TABLE}`"
    paths = pipeline_paths(spark, sf_dir, folder)
    run(spark, paths, database=database, show=False)
    with suppress(EmptyResult):
        # No row of the table itself is chosen; Gold need not be made a second time for that.
        publish_gold(metrics.filter_rows(read_published(spark, table), [""]), paths, table, show=False)
    return snake_names(read_published(spark, table))


@contextmanager
def counted_by_a_reader(spark, table: str):
    """The row counts that a reader sees who asks again and again."""
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(spark.read.table(table).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        yield seen
    finally:
        done.set()
        reader.join()


def publish_atomic(spark, sf_dir):
    """Gold with a count of the partial versions that a reader saw while it was published: none."""
    database, folder = new_database(spark, "atomic")
    table, paths = f"`{database}`.`{catalog.GOLD_TABLE}`", Paths.under(folder)
    catalog.create_tables(spark, paths, database)
    gold = gold_table(spark, sf_dir)
    # Other states, other rows: every partition of one version goes and every one of the other comes.
    old = gold.filter("state <> 'S1'").withColumn("state", F.concat(F.lit("old "), "state"))
    before = publish_gold(old, paths, table, show=False)
    with counted_by_a_reader(spark, table) as seen:
        after = publish_gold(gold, paths, table, show=False)
    torn = sum(count not in (before, after) for count in seen)
    return snake_names(read_published(spark, table)).withColumn("torn", F.lit(torn))


#: Names that need an escape in a path, a URI or a SQL text, by the state that takes them.
SPECIAL = {"S1": "A B", "S2": "A/B", "S3": "A=B", "S4": "50%", "S5": "O'x", "S6": "A:B"}


def publish_dynamic_special(spark, sf_dir):
    """States of special names, three of them published again on their own."""
    database, folder = new_database(spark, "dynamic")
    table, paths = f"`{database}`.`{catalog.GOLD_TABLE}`", Paths.under(folder)
    catalog.create_tables(spark, paths, database)
    gold = clean.recode(gold_table(spark, sf_dir), {"state": SPECIAL})
    publish_gold(gold, paths, table, show=False)
    again = metrics.filter_rows(gold, ["A/B", "50%", "A:B"]).withColumn("Discharges", F.lit("again"))
    publish_gold(again, paths, table, dynamic=True, show=False)
    return snake_names(read_published(spark, table))


def lost_keys(spark, sf_dir):
    """Facilities whose key outgrows the declared type: the strict Silver job raises on them."""
    folder = fresh_folder(spark, "lost-keys")
    large = F.when(F.col("provider id") % 7 == 0, F.col("provider id") + (1 << 31))
    key = F.coalesce(large, "provider id")
    inputs.facilities(spark, sf_dir).withColumn("provider id", key).write.json(f"{folder}/raw")
    try:
        build_gen_info(spark, f"{folder}/raw", f"{folder}/silver")
        raised = False
    except LostKeys:
        raised = True
    counts = spark.read.parquet(f"{folder}/silver").agg(
        F.count(F.lit(1)).alias("c"), F.count("provider id").alias("keys")
    )
    return counts.withColumn("raised", F.lit(raised))


def default_database(spark, sf_dir):
    """Counts by unqualified table names."""
    database, folder = new_database(spark, "default")
    run(spark, pipeline_paths(spark, sf_dir, folder), "silver", database=database)
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    try:
        return catalog.count_rows(spark, catalog.GEN_INFO_TABLE)
    finally:
        spark.catalog.setCurrentDatabase(before)


# --- CSV snapshot ---


def snapshots(spark, sf_dir, purpose: str, **options) -> str:
    """An old snapshot of one state, then a new one of all Gold rows."""
    folder = fresh_folder(spark, purpose)
    df = gold_table(spark, sf_dir)
    write_snapshot(metrics.filter_rows(df, ["S1"]), f"{folder}/old")
    write_snapshot(df, f"{folder}/new", **options)
    return folder


def latest_snapshot(spark, sf_dir):
    return snake_names(read_latest_snapshot(spark, snapshots(spark, sf_dir, "snapshot")))


def latest_snapshot_parts(spark, sf_dir):
    folder = snapshots(spark, sf_dir, "snapshot-parts", single_file=False)
    return snake_names(read_latest_snapshot(spark, folder))


def latest_snapshot_rolled(spark, sf_dir):
    """Tasks that write several files each."""
    # Gold and what it is made of are written before: the limit is for the snapshot's files.
    gold_table(spark, sf_dir)
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    try:
        folder = snapshots(spark, sf_dir, "snapshot-rolled", single_file=False)
    finally:
        spark.conf.set(key, before)
    return snake_names(read_latest_snapshot(spark, folder))


def snapshot_blanks(spark, sf_dir):
    """Values with blanks around them, and one that only looks like the sentinel."""
    folder = fresh_folder(spark, "snapshot-blanks")
    padded = F.concat(F.lit(" "), F.coalesce("Discharges", F.lit("Not Available")), F.lit(" "))
    write_snapshot(gold_table(spark, sf_dir).withColumn("Discharges", padded), folder)
    return snake_names(read_latest_snapshot(spark, folder))


def snapshot_line_breaks(spark, sf_dir):
    """Values with line breaks in them: the record has the file read whole."""
    folder = fresh_folder(spark, "snapshot-line-breaks")
    broken = F.concat(F.lit("a\n"), F.coalesce("Discharges", F.lit("none")), F.lit('", "b'))
    write_snapshot(gold_table(spark, sf_dir).withColumn("Discharges", broken), folder)
    return snake_names(read_latest_snapshot(spark, folder))


#: Tasks that read a snapshot's file at most, to show that it is split.
MOST_SPLITS = 500


def snapshot_logged(spark, sf_dir):
    """The newest of two snapshots by the log above them, and that its only file is read by several tasks."""
    folder = fresh_folder(spark, "snapshot-logged")
    df = gold_table(spark, sf_dir)
    write_snapshot(metrics.filter_rows(df, ["S1"]), f"{folder}/old", log=folder)
    write_snapshot(df, f"{folder}/new", log=folder)
    rows = load_latest_snapshot(spark, folder).rows
    # Splits grow with the file beyond MOST_SPLITS of them: every task reports to the driver.
    options = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.maxPartitionNum": str(MOST_SPLITS)}
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        seen = rows.select("*", F.spark_partition_id().alias("task"), "_metadata.file_path").agg(
            F.count(F.lit(1)).alias("c"),
            F.countDistinct("file_path").alias("files"),
            (F.countDistinct("task") > 1).alias("split"),
        )
        return spark.createDataFrame(seen.collect(), seen.schema)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def snapshot_files(spark, sf_dir):
    df = read_latest_snapshot(spark, snapshots(spark, sf_dir, "snapshot-files"))
    counted = df.select(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("c"), F.countDistinct("file").alias("files")
    )
    return counted.select("c", F.col("files"))


def provenance(spark, sf_dir):
    """Where the rows come from: the newest of two snapshots."""
    folder = snapshots(spark, sf_dir, "snapshot-provenance")
    snapshot = load_latest_snapshot(spark, folder)
    return snapshot.rows.agg(F.count(F.lit(1)).alias("c")).select(
        "c",
        F.lit(snapshot.path).contains(f"{folder}/new/part-").alias("is_newest"),
        F.lit(snapshot.last_updated).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d UTC$").alias("is_utc"),
    )


def snapshot_kpis(spark, sf_dir):
    folder = snapshots(spark, sf_dir, "snapshot-dashboard")
    choices = {"states": STATES, "readm_types": TYPES, "metric": "Pred Readm Rate"}
    return rounded(snapshot_dashboard(spark, folder, **choices)[1]["kpis"])


# --- the analyst query set over a summary ---


@once_per_application
def stored_summary(spark, sf_dir, folder):
    write_summary(gold_table(spark, sf_dir), folder)


def summarised(spark, sf_dir, view: str, **choices) -> DataFrame:
    """A dashboard view that comes from the stored summary."""
    summary = read_summary(spark, stored_summary(spark, sf_dir))
    return snake_names(dashboard(gold_table(spark, sf_dir), summary=summary, **choices)[view])


SELECTION = {"states": STATES, "readm_types": TYPES, "group_by": "Hosp Rating", "metric": "Pred Readm Rate"}

#: Query, view and choices; the SQL is that of the query over Gold itself.
SUMMARISED = {
    "summary_kpis": ("kpis", {}),
    "summary_kpis_filtered": ("kpis", {"states": STATES, "readm_types": TYPES, "metric": "Discharges"}),
    "summary_kpis_empty": ("kpi_labels", {"states": [""]}),
    "summary_kpi_labels": ("kpi_labels", {}),
    "summary_mean_by_ownership": ("mean_by_group", {}),
    "summary_mean_by_rating": ("mean_by_group", {"group_by": "Hosp Rating", "metric": "Readmissions"}),
    "summary_mean_by_state": ("mean_by_state", {}),
    "summary_selected_kpis": ("kpis", SELECTION),
    "summary_selected_mean_by_group": ("mean_by_group", SELECTION),
    "summary_selected_mean_by_state": ("mean_by_state", SELECTION),
    "summary_states": ("states", {}),
    "summary_types": ("readm_types", {}),
}


def summary_query(view: str, choices: dict):
    def query(spark, sf_dir):
        df = summarised(spark, sf_dir, view, **choices)
        return df if view in ("states", "readm_types", "kpi_labels") else rounded(df)

    return query


# --- the analyst query set over a selection ---


def selection(df: DataFrame) -> dict[str, DataFrame]:
    return dashboard(
        df, states=STATES, readm_types=TYPES, group_by="Hosp Rating", metric="Pred Readm Rate"
    )


def queries():
    over_gold = {
        "gold_count": lambda df: df.agg(F.count(F.lit(1)).alias("c")),
        "kpi_summary": lambda df: rounded(metrics.kpis(df, "R Rate Diff")),
        "kpi_summary_filtered": lambda df: rounded(
            metrics.kpis(metrics.filter_rows(df, STATES, TYPES), "Discharges")
        ),
        "kpi_labels": lambda df: metrics.kpi_labels(df, "R Rate Diff"),
        "kpi_labels_empty": lambda df: metrics.kpi_labels(
            metrics.filter_rows(df, [""]), "R Rate Diff"
        ),
        "mean_by_ownership": lambda df: rounded(
            metrics.mean_by(df, "Hosp Ownership", "R Rate Diff")
        ),
        "mean_by_rating": lambda df: rounded(metrics.mean_by(df, "Hosp Rating", "R Rate Diff")),
        "mean_by_rating_text_metric": lambda df: rounded(
            metrics.mean_by(df, "Hosp Rating", "Readmissions")
        ),
        "mean_by_state": lambda df: rounded(metrics.mean_by_state(df, "R Rate Diff")),
        "histogram_exact": lambda df: histogram(df, "R Rate Diff"),
        "histogram_exact_text_metric": lambda df: histogram(df, "Discharges"),
        "histogram_dense": lambda df: histogram(df, "R Rate Diff", dense=True),
        "histogram_nice": lambda df: histogram(df, "R Rate Diff", mode="nice"),
        "histogram_nice_text_metric": lambda df: histogram(df, "Excess Readm Ratio", mode="nice"),
        "filter_state_type": lambda df: metrics.filter_rows(df, STATES, TYPES),
        "filter_none": lambda df: metrics.filter_rows(df, [], []),
        "states_list": lambda df: metrics.picklist(df, "state"),
        "types_list": lambda df: metrics.picklist(df, "Readm Type"),
        "dashboard_kpis": lambda df: rounded(selection(df)["kpis"]),
        "dashboard_kpi_labels": lambda df: selection(df)["kpi_labels"],
        "dashboard_mean_by_group": lambda df: rounded(selection(df)["mean_by_group"]),
        "dashboard_mean_by_state": lambda df: rounded(selection(df)["mean_by_state"]),
        "dashboard_histogram": lambda df: selection(df)["histogram"],
        "dashboard_rows": lambda df: selection(df)["rows"],
        "preview_10": first_rows,
    }
    registered = {
        "json_scan_facilities": json_scan_facilities,
        "json_row_count": json_row_count,
        "csv_scan_measures": csv_scan_measures,
        "csv_scan_inferred": csv_scan_inferred,
        "conform_rename": conform_rename,
        "conform_mixed": conform_mixed,
        "json_quarantine": json_quarantine,
        "conform_missing_columns": conform_missing_columns,
        "parquet_silver_roundtrip": parquet_silver_roundtrip,
        "project_facility": lambda spark, sf_dir: snake_names(
            project_facility(facilities(spark, sf_dir))
        ),
        "project_measures": lambda spark, sf_dir: snake_names(
            project_measures(measures(spark, sf_dir))
        ),
        "right_join_raw": lambda spark, sf_dir: snake_names(derived_merged(spark, sf_dir)),
        "right_join_shuffled": lambda spark, sf_dir: snake_names(
            derived_merged(spark, sf_dir, broadcast_limit=0)
        ),
        "right_join_salted": lambda spark, sf_dir: snake_names(
            derived_merged(spark, sf_dir, broadcast=False, rows_per_task=5)
        ),
        "null_sentinel": null_sentinel,
        "require_columns": require_columns,
        "recode_measure": lambda spark, sf_dir: recoded_counts(
            project_measures(measures(spark, sf_dir)), "Readm Type", READM_TYPES
        ),
        "recode_ownership": lambda spark, sf_dir: recoded_counts(
            project_facility(facilities(spark, sf_dir)), "Hosp Ownership", OWNERSHIPS
        ),
        "recode_rating": lambda spark, sf_dir: recoded_counts(
            project_facility(facilities(spark, sf_dir)), "Hosp Rating", RATINGS
        ),
        "rate_diff": rate_diff,
        "gold": lambda spark, sf_dir: snake_names(derived_gold(spark, sf_dir)),
        "gold_shuffled": lambda spark, sf_dir: snake_names(
            derived_gold(spark, sf_dir, broadcast_limit=0)
        ),
        "gold_salted": lambda spark, sf_dir: snake_names(
            derived_gold(spark, sf_dir, broadcast=False, rows_per_task=5)
        ),
        "gold_partitioned_roundtrip": gold_partitioned_roundtrip,
        "gold_partition_pruned": gold_partition_pruned,
        "gold_repaired_count": gold_repaired_count,
        "table_checks": table_checks,
        "full_run": full_run,
        "full_run_shuffled": full_run_shuffled,
        "full_run_summary": full_run_summary,
        "two_locations": two_locations,
        "empty_gold_keeps_old": empty_gold_keeps_old,
        "publish_atomic": publish_atomic,
        "publish_dynamic_special": publish_dynamic_special,
        "lost_keys": lost_keys,
        "default_database": default_database,
        "latest_snapshot": latest_snapshot,
        "latest_snapshot_parts": latest_snapshot_parts,
        "latest_snapshot_rolled": latest_snapshot_rolled,
        "snapshot_blanks": snapshot_blanks,
        "snapshot_line_breaks": snapshot_line_breaks,
        "snapshot_logged": snapshot_logged,
        "snapshot_dashboard_kpis": snapshot_kpis,
        "snapshot_files": snapshot_files,
        "snapshot_provenance": provenance,
    }
    registered |= {name: summary_query(*chosen) for name, chosen in SUMMARISED.items()}
    for name, query in over_gold.items():
        registered[name] = lambda spark, sf_dir, query=query: snake_names(
            query(gold_table(spark, sf_dir))
        )
    return registered
