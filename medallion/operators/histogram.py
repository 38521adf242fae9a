"""Histogram of a metric in equal bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.errors import UnknownOption
from medallion.functions.clean import metric_value
from medallion.operators.metrics import check_metric
from medallion.schemas import HISTOGRAM_BINS


def histogram(
    df: DataFrame,
    metric: str,
    *,
    bins: int = HISTOGRAM_BINS,
    mode: str = "exact",
    dense: bool = False,
) -> DataFrame:
    """Rows (bin, bin_start, n) in bin order; null and infinite values have no bin.

    ``exact`` cuts the range into ``bins`` equal parts, the maximum falling into the last.
    ``nice`` takes the smallest round width (1, 2 or 5 times a power of ten) that needs at most
    ``bins`` bins starting at multiples of it. A constant column has one bin. Empty bins are
    absent unless ``dense``.

    The bounds are a scalar subquery over one aggregate row: nothing is joined, and the count
    shuffles at most ``bins`` rows per task.
    """
    if mode not in ("exact", "nice"):
        raise UnknownOption(f"histogram mode {mode!r}")
    if bins < 1:
        raise UnknownOption(f"{bins} bins")
    check_metric(df, metric)
    values = df.select(metric_value(metric).alias("v")).filter(F.abs("v") < float("inf"))
    bounds = _bounds(values, bins, mode)
    v, lo, width, first = F.col("v"), F.col("b.lo"), F.col("b.width"), F.col("b.first")
    place = F.floor((v - lo) / width) if mode == "exact" else F.floor(v / width) - first
    start = lo + F.col("bin") * width if mode == "exact" else (first + F.col("bin")) * width
    counted = (
        values.select(v, bounds.scalar().alias("b"))
        .select(F.least(place, F.col("b.last")).cast("int").alias("bin"), "b.*")
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.struct(*(F.any_value(c).alias(c) for c in ("lo", "width", "first"))).alias("b"),
        )
    )
    if dense:
        numbers = F.explode(F.sequence(F.lit(0), F.col("b.last").cast("int")))
        every = bounds.select(numbers.alias("bin"), "b")
        # At most one row per bin on either side.
        counted = every.join(F.broadcast(counted.drop("b")), "bin", "left").fillna(0, ["n"])
    return counted.select("bin", start.alias("bin_start"), "n").orderBy("bin")


def _bounds(values: DataFrame, bins: int, mode: str) -> DataFrame:
    """One row, one struct: lowest value, bin width, number of the first bin, last bin."""
    lo, hi = F.col("lo"), F.col("hi")
    raw = (hi - lo) / bins
    extremes = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if mode == "exact":
        width, last = raw, F.lit(bins - 1)
        first = F.lit(0)
    else:
        width = _round_width(lo, hi, raw, bins)
        first = F.floor(lo / F.col("width"))
        last = F.floor(hi / F.col("width")) - first
    width = F.when(raw > 0, width).when(raw == 0, 1.0)
    last = F.when(raw > 0, last).when(raw == 0, 0)
    return (
        extremes.withColumn("width", width)
        .withColumn("first", first)
        .select(F.struct("lo", "width", "first", last.cast("long").alias("last")).alias("b"))
    )


def _round_width(lo: Column, hi: Column, raw: Column, bins: int) -> Column:
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    widths = [step * power for step in (1, 2, 5, 10, 20)]
    return F.coalesce(
        *(
            F.when((w >= raw) & (F.floor(hi / w) - F.floor(lo / w) < bins), w)
            for w in widths
        ),
        widths[-1],
    )
