"""The analyst query set over Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.errors import EmptyInput
from medallion.operators.histogram import histogram
from medallion.operators.metrics import (
    filter_rows,
    kpi_labels,
    kpis,
    mean_by,
    mean_by_state,
    picklist,
)
from medallion.plans.summary import kpi_labels_of, kpis_of, means_of, totals
from medallion.sources.snapshot import Snapshot, load_latest_snapshot


def dashboard(
    df: DataFrame,
    *,
    states=(),
    readm_types=(),
    group_by: str = "Hosp Ownership",
    metric: str = "R Rate Diff",
    summary: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All dashboard results as lazy frames: picklists over ``df``, the rest over the selection.

    Over the Gold table the state choice prunes partitions and each result reads its own columns. With
    a ``summary`` of ``df``, KPIs and means come from one aggregation over it, ``totals``, and Gold is
    scanned for histogram and rows only.
    """
    chosen = filter_rows(df, states, readm_types)
    views = {"histogram": histogram(chosen, metric), "rows": chosen}
    if summary is not None:
        sums = totals(summary, group_by, metric, states, readm_types)
        mean = F.desc_nulls_last("avg_metric")
        return views | {
            "totals": sums,
            "states": picklist(summary, "state"),
            "readm_types": picklist(summary, "Readm Type"),
            "kpis": kpis_of(sums),
            "kpi_labels": kpi_labels_of(sums),
            "mean_by_group": means_of(sums, "group", group_by).orderBy(mean, F.col(f"`{group_by}`")),
            "mean_by_state": means_of(sums, "state", "state").orderBy("state"),
        }
    return views | {
        "states": picklist(df, "state"),
        "readm_types": picklist(df, "Readm Type"),
        "kpis": kpis(chosen, metric),
        "kpi_labels": kpi_labels(chosen, metric),
        "mean_by_group": mean_by(chosen, group_by, metric),
        "mean_by_state": mean_by_state(chosen, metric),
    }


def snapshot_dashboard(
    spark: SparkSession, folder: str, **choices
) -> tuple[Snapshot, dict[str, DataFrame]]:
    """The newest snapshot below ``folder`` and all dashboard results over it; raises without rows."""
    snapshot = load_latest_snapshot(spark, folder)
    if snapshot.path is None or snapshot.rows.isEmpty():
        raise EmptyInput(f"no snapshot with rows below {folder}")
    return snapshot, dashboard(snapshot.rows, **choices)
