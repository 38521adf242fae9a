"""Catalog tables over the Silver and Gold locations."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from medallion.errors import LocationMismatch
from medallion.locations import Paths, exists, make_folder, qualified, subfolders
from medallion.schemas import GEN_INFO, GOLD, PARTITION_COLUMN, READMISSIONS

DATABASE = "medallion"
GEN_INFO_TABLE = "gen_info"
READMISSIONS_TABLE = "readmissions"
GOLD_TABLE = "gold_merged"

#: Where a version folder records its publication, and partitions that one statement covers.
MANIFEST = "_manifest"
PARTITION_BATCH = 500

_MANIFEST_SCHEMA = "state string, folder string"
_EMPTY = "_empty"
#: Spark's directory name of a null or empty partition value.
_NULL_STATE = "__HIVE_DEFAULT_PARTITION__"


def build_session(
    app_name: str, *, hive: bool = False, metastore_client_factory: str | None = None
) -> SparkSession:
    """A session for the pipeline; ``hive`` binds the catalog to a persistent metastore."""
    builder = SparkSession.builder.appName(app_name)
    if metastore_client_factory:
        hive = True
        builder = builder.config("hive.metastore.client.factory.class", metastore_client_factory)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def create_tables(
    spark: SparkSession, paths: Paths, database: str = DATABASE, *, move: bool = False
) -> None:
    """Declare the external tables that are not there yet.

    A table that lies elsewhere raises, or is declared anew at its place in ``paths`` if ``move``
    is set; its old files stay. Gold may lie in any folder below its place, as publications do.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table, schema, location, partitioning in [
        (GEN_INFO_TABLE, GEN_INFO, paths.gen_info, ""),
        (READMISSIONS_TABLE, READMISSIONS, paths.readmissions, ""),
        (GOLD_TABLE, GOLD, paths.gold, f"PARTITIONED BY (`{PARTITION_COLUMN}`)"),
    ]:
        name = f"`{database}`.`{table}`"
        if spark.catalog.tableExists(name):
            present, wanted = table_location(spark, name), qualified(spark, location)
            if present == wanted or partitioning and present.startswith(f"{wanted}/"):
                continue
            if not move:
                raise LocationMismatch(f"{name} lies at {present}, not at {wanted}")
            spark.sql(f"DROP TABLE {name}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) "
            f"USING parquet {partitioning} LOCATION '{_quoted(location)}'"
        )


def table_location(spark: SparkSession, table: str) -> str:
    """Where a table lies, as a full URI."""
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
    return qualified(spark, described.first()["data_type"])


def partition_folders(spark: SparkSession, folder: str) -> dict[str | None, str]:
    """State and place of each partition directory right below ``folder``; None is the null state."""
    found = {}
    for place in subfolders(spark, folder):
        name, marked, value = place.rsplit("/", 1)[1].partition("=")
        if marked and name == PARTITION_COLUMN:
            found[_state_of(value)] = place
    return found


def write_manifest(spark: SparkSession, folder: str, states: dict[str | None, str]) -> None:
    """Record, in the version ``folder``, where the rows of each state of the publication lie.

    The record is one table, so it is there as a whole or not at all. Its name hides it from scans.
    """
    rows = spark.createDataFrame(sorted(states.items(), key=str), _MANIFEST_SCHEMA)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")


def read_manifest(spark: SparkSession, table: str) -> dict[str | None, str]:
    """State and place of the table's rows as its last publication recorded them.

    A table that no publication has touched has those partitions that are registered at its place.
    """
    location = table_location(spark, table)
    if exists(spark, f"{location}/{MANIFEST}/_SUCCESS"):
        rows = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{location}/{MANIFEST}")
        return {row["state"]: row["folder"] for row in rows.collect()}
    registered = _registered(spark, table)
    return {s: f for s, f in partition_folders(spark, location).items() if s in registered}


def show_manifest(spark: SparkSession, table: str, folder: str) -> None:
    """Make the table show the publication recorded in ``folder``, all at once to its readers.

    New states are registered at an empty place first and gone states are dropped last, both without
    an effect on what is read. In between, one catalog operation gives every partition its new
    place. The statements cover whole batches of partitions. The new places are staged in a table of
    their own, dropped at the end: where it is left, a publication broke off, and showing the
    manifest at the table's location again completes it.
    """
    staged, names = _staged(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    empty = f"{folder}/{_EMPTY}"
    make_folder(spark, empty)
    spark.sql(
        f"CREATE TABLE {staged} ({GOLD.toDDL()}) USING parquet "
        f"PARTITIONED BY (`{PARTITION_COLUMN}`) LOCATION '{_quoted(empty)}'"
    )
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(folder)}'")
    wanted, registered = read_manifest(spark, table), _registered(spark, table)
    gone = [s for s in registered if s not in wanted]
    _add_partitions(spark, staged, {**wanted, **{s: empty for s in gone}})
    _add_partitions(spark, table, {s: empty for s in wanted if s not in registered})
    _switch_partitions(spark, *names)
    spark.catalog.refreshTable(table)
    for batch in _batches(gone):
        specs = ", ".join(_partition(state) for state in batch)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    spark.sql(f"DROP TABLE {staged}")


def complete_publication(spark: SparkSession, table: str) -> None:
    """Show what a publication has recorded, if it broke off before the table showed it."""
    if spark.catalog.tableExists(_staged(spark, table)[0]):
        location = table_location(spark, table)
        if exists(spark, f"{location}/{MANIFEST}/_SUCCESS"):
            show_manifest(spark, table, location)


def _staged(spark: SparkSession, table: str) -> tuple[str, tuple[str, str, str]]:
    found = spark.catalog.getTable(table)
    database, name = found.namespace[0], found.name
    return f"`{database}`.`{name}__next`", (database, name, f"{name}__next")


def _switch_partitions(spark: SparkSession, database: str, table: str, staged: str) -> None:
    # SQL can move one partition a statement only; the catalog takes them all in one call.
    external = spark._jsparkSession.sharedState().externalCatalog()
    partitions = external.listPartitions(database, staged, spark._jvm.scala.Option.empty())
    external.alterPartitions(database, table, partitions)


def _add_partitions(spark: SparkSession, table: str, places: dict[str | None, str]) -> None:
    for batch in _batches(list(places)):
        specs = " ".join(f"{_partition(s)} LOCATION '{_quoted(places[s])}'" for s in batch)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def _registered(spark: SparkSession, table: str) -> list[str | None]:
    named = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [_state_of(row["partition"].split("=", 1)[1]) for row in named]


def _state_of(directory_value: str) -> str | None:
    return None if directory_value == _NULL_STATE else unquote(directory_value)


def _partition(state: str | None) -> str:
    value = "null" if state is None else f"'{_quoted(state)}'"
    return f"PARTITION (`{PARTITION_COLUMN}` = {value})"


def _batches(items: list) -> list[list]:
    return [items[k : k + PARTITION_BATCH] for k in range(0, len(items), PARTITION_BATCH)]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def use_database(spark: SparkSession, database: str = DATABASE) -> None:
    """Make unqualified table names resolve in ``database``."""
    spark.catalog.setCurrentDatabase(database)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table by (qualified) name, files as they are now."""
    spark.catalog.refreshTable(table)
    return spark.read.table(table)


def count_rows(spark: SparkSession, table: str) -> DataFrame:
    """One row ``c``: the number of rows of a table, from the footers of its present files."""
    spark.catalog.refreshTable(table)
    return spark.sql(f"SELECT count(1) AS c FROM {table} LIMIT 1")


def check_tables(spark: SparkSession, tables: list[str]) -> dict[str, int]:
    """Row count per table; raises if one cannot be read."""
    return {table: count_rows(spark, table).first()["c"] for table in tables}


def repair_partitions(spark: SparkSession, table: str, *, drop_missing: bool = False) -> None:
    """Register the partition directories on disk, and forget missing ones if asked to."""
    spark.sql(f"MSCK REPAIR TABLE {table} {'SYNC PARTITIONS' if drop_missing else ''}")
