"""Filters, picklists, KPIs and group means over Gold rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.errors import UnknownOption
from medallion.functions.clean import kpi_label, metric_value
from medallion.operators.conform import require_columns
from medallion.schemas import GROUP_OPTIONS, METRIC_OPTIONS


def filter_rows(df: DataFrame, states=(), readm_types=()) -> DataFrame:
    """Rows of the chosen states and measure types; an empty choice keeps all.

    A choice is a list; a single text would be taken letter by letter, so it raises.
    """
    for choice in (states, readm_types):
        if isinstance(choice, str):
            raise UnknownOption(f"{choice!r} is no list of values")
    if states:
        df = df.filter(F.col("state").isin(list(states)))
    if readm_types:
        df = df.filter(F.col("Readm Type").isin(list(readm_types)))
    return df


def picklist(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column, ascending."""
    require_columns(df, column)
    c = F.col(f"`{column}`")
    return df.select(c).filter(c.isNotNull()).distinct().orderBy(c)


def kpis(df: DataFrame, metric: str) -> DataFrame:
    """One row: mean of the metric (null without a number), distinct facilities and states.

    Rows first collapse to one partial sum per facility and state, inside each task already, so
    neither a heavy facility nor the two distinct counts multiply what is shuffled.
    """
    check_metric(df, metric)
    require_columns(df, "provider_id", "state")
    partial = df.groupBy("provider_id", "state").agg(
        F.sum(metric_value(metric)).alias("total"),
        F.count(metric_value(metric)).alias("n"),
    )
    return partial.agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("avg_metric"),
        F.countDistinct("provider_id").alias("hospitals"),
        F.countDistinct("state").alias("states"),
    )


def kpi_labels(df: DataFrame, metric: str) -> DataFrame:
    """``kpis`` with the mean as text."""
    return kpis(df, metric).withColumn("avg_metric", kpi_label(F.col("avg_metric")))


def mean_by(df: DataFrame, group: str, metric: str) -> DataFrame:
    """Mean of the metric per group, highest first, groups without a number last."""
    if group not in GROUP_OPTIONS:
        raise UnknownOption(f"group column {group!r}, allowed: {GROUP_OPTIONS}")
    key = F.col(f"`{group}`")
    return _group_mean(df, group, metric).orderBy(F.desc_nulls_last("avg_metric"), key)


def mean_by_state(df: DataFrame, metric: str) -> DataFrame:
    """Mean of the metric per state, states ascending."""
    return _group_mean(df, "state", metric).orderBy("state")


def _group_mean(df: DataFrame, key: str, metric: str) -> DataFrame:
    check_metric(df, metric)
    require_columns(df, key)
    k = F.col(f"`{key}`")
    return df.filter(k.isNotNull()).groupBy(k).agg(F.avg(metric_value(metric)).alias("avg_metric"))


def check_metric(df: DataFrame, metric: str) -> None:
    """Raise unless the metric is on the list and in the frame."""
    if metric not in METRIC_OPTIONS:
        raise UnknownOption(f"metric {metric!r}, allowed: {METRIC_OPTIONS}")
    require_columns(df, metric)
