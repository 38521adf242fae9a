"""A summary of Gold from which the KPIs and means of any selection follow without another scan of it.

One aggregation gives a row per state, measure type, ownership, rating and bucket of facility keys:
sum and count of every metric, and the facilities as a bitmap. Bitmaps merge without counting a facility
twice, so distinct counts stay exact under every filter. A bitmap covers up to 32,768 neighbouring keys
and holds those of its 512 words that are not zero, 6 KiB at most; the summary grows with the
combinations that occur, not with the rows. Words are merged as numbers under their place, so no task
sorts or shuffles bitmaps that are mostly empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.errors import UnknownOption
from medallion.functions.clean import kpi_label, metric_value
from medallion.operators.conform import require_columns
from medallion.operators.metrics import filter_rows
from medallion.schemas import GROUP_OPTIONS, METRIC_OPTIONS

DIMENSIONS = ["state", "Readm Type", *GROUP_OPTIONS]


def summarise(df: DataFrame) -> DataFrame:
    """Sums, counts and facility bitmaps of Gold rows by state, type, ownership, rating and key bucket."""
    require_columns(df, "provider_id", *DIMENSIONS, *METRIC_OPTIONS)
    sums = []
    for metric in METRIC_OPTIONS:
        value = metric_value(metric)
        sums += [F.sum(value).alias(f"total {metric}"), F.count(value).alias(f"n {metric}")]
    place = F.bitmap_bit_position("provider_id")
    bucket = F.bitmap_bucket_number("provider_id").alias("bucket")
    word = F.shiftright(place, 6).cast("int").alias("word")
    bits = F.bit_or(F.expr("shiftleft(1L, cast(bitmap_bit_position(provider_id) % 64 as int))")).alias("bits")
    dimensions = [F.col(f"`{c}`") for c in DIMENSIONS]
    words = df.groupBy(*dimensions, bucket, word).agg(bits, *sums)
    listed = F.collect_list(F.when(F.col("bits").isNotNull(), F.struct("word", "bits"))).alias("facilities")
    names = [f"{part} {metric}" for metric in METRIC_OPTIONS for part in ("total", "n")]
    merged = [F.sum(f"`{n}`").alias(n) for n in names]
    return words.groupBy(*dimensions, "bucket").agg(listed, *merged)


def write_summary(df: DataFrame, path: str) -> None:
    """Replace the summary at ``path`` by that of Gold rows."""
    summarise(df).write.mode("overwrite").parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def totals(summary: DataFrame, group: str, metric: str, states=(), readm_types=()) -> DataFrame:
    """All sums that KPIs and means of a selection need, by one aggregation over its summary rows.

    ``kind`` tells the rows apart: one per bucket of facility keys, per state and per ``group`` value.
    Facilities are counted by bucket, as the same bit of two buckets stands for two of them.
    """
    if group not in GROUP_OPTIONS:
        raise UnknownOption(f"group column {group!r}, allowed: {GROUP_OPTIONS}")
    if metric not in METRIC_OPTIONS:
        raise UnknownOption(f"metric {metric!r}, allowed: {METRIC_OPTIONS}")
    chosen = filter_rows(summary, states, readm_types).select(
        "bucket",
        "state",
        F.col(f"`{group}`").alias("group"),
        "facilities",
        F.col(f"`total {metric}`").alias("total"),
        F.col(f"`n {metric}`").alias("n"),
    )
    # Each kind of rows that a summary row counts in; its words count in its bucket.
    nothing = {"bucket": "long", "state": "string", "group": "string", "word": "int", "bits": "long", "total": "double", "n": "long"}

    def entry(kind: str, **given: Column) -> Column:
        fields = [given.get(c, F.lit(None)).cast(t).alias(c) for c, t in nothing.items()]
        return F.struct(F.lit(kind).alias("kind"), *fields)

    sums = {"total": F.col("total"), "n": F.col("n")}
    kinds = F.array(*(entry(c, **{c: F.col(c)}, **sums) for c in ("bucket", "state", "group")))
    words = F.transform("facilities", lambda w: entry("bucket", bucket=F.col("bucket"), word=w["word"], bits=w["bits"]))
    entries = chosen.select(F.explode(F.concat(kinds, words)).alias("e")).select("e.*")
    keys = ["kind", "bucket", "state", "group"]
    merged = entries.groupBy(*keys, "word").agg(
        F.bit_or("bits").alias("bits"), F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    return merged.groupBy(*keys).agg(
        F.sum(F.bit_count("bits")).alias("facilities"),
        F.sum("total").alias("total"),
        F.sum("n").alias("n"),
    )


def kpis_of(sums: DataFrame) -> DataFrame:
    """One row of ``totals``: mean of the metric, distinct facilities and states."""
    facilities = F.col("kind") == "bucket"
    return sums.agg(
        F.try_divide(_sum_where(facilities, "total"), _sum_where(facilities, "n")).alias("avg_metric"),
        F.coalesce(_sum_where(facilities, "facilities"), F.lit(0)).cast("long").alias("hospitals"),
        F.count_if((F.col("kind") == "state") & F.col("state").isNotNull()).alias("states"),
    )


def kpi_labels_of(sums: DataFrame) -> DataFrame:
    """``kpis_of`` with the mean as text."""
    return kpis_of(sums).withColumn("avg_metric", kpi_label(F.col("avg_metric")))


def means_of(sums: DataFrame, kind: str, name: str) -> DataFrame:
    """Mean of the metric per value of a kind of rows, under the column ``name``; null values have none."""
    rows = sums.filter((F.col("kind") == kind) & F.col(kind).isNotNull())
    return rows.select(F.col(kind).alias(name), F.try_divide("total", "n").alias("avg_metric"))


def _sum_where(condition: Column, column: str) -> Column:
    return F.sum(F.when(condition, F.col(column)))
