from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from frames import gold_rows, physical_plan_of, rows
from medallion import dashboard
from medallion.errors import MissingColumns, UnknownOption
from medallion.operators.histogram import histogram
from medallion.operators.metrics import (
    filter_rows,
    kpi_labels,
    kpis,
    mean_by,
    mean_by_state,
    picklist,
)
from medallion.plans.summary import kpis_of, read_summary, summarise, totals, write_summary
from medallion.sinks import write_gold
from medallion.sources import read_gold


@pytest.fixture(scope="module")
def sample(spark):
    names = [
        "provider_id",
        "state",
        "Readm Type",
        "R Rate Diff",
        "Hosp Rating",
        "Hosp Ownership",
        "Discharges",
    ]
    values = [
        (1, "AK", "AMI", 1.0, "1 Star", "Prop", "10"),
        (1, "AK", "Hip_Knee", 2.0, "1 Star", "Prop", "Too Few"),
        (2, "TX", "AMI", 6.0, "2 Star", "Local", "20"),
        (None, "TX", "AMI", None, "3 Star", None, "NaN"),
        (3, None, None, 7.0, None, "Tribal", None),
    ]
    return gold_rows(spark, *(dict(zip(names, v, strict=True)) for v in values))


def test_filters(sample):
    assert filter_rows(sample).count() == 5
    assert filter_rows(sample, [], []).count() == 5
    assert filter_rows(sample, ["TX"]).count() == 2
    assert filter_rows(sample, ["AK", "TX"], ["AMI"]).count() == 3
    assert filter_rows(sample, readm_types=["Hip_Knee"]).count() == 1


def test_picklists_are_sorted_without_null(sample):
    assert [r[0] for r in picklist(sample, "state").collect()] == ["AK", "TX"]
    assert [r[0] for r in picklist(sample, "Readm Type").collect()] == ["AMI", "Hip_Knee"]


def test_kpis(sample):
    assert kpis(sample, "R Rate Diff").collect() == [(4.0, 3, 2)]
    assert kpis(sample, "Discharges").collect() == [(15.0, 3, 2)]


def test_kpis_equal_the_direct_aggregates_on_random_rows(spark):
    rng = random.Random(3)
    df = gold_rows(
        spark,
        *(
            {
                "provider_id": rng.choice([None, 1, 1, 1, 2, 3, 4]),
                "state": rng.choice([None, "A", "A", "B"]),
                "Discharges": rng.choice([None, "1", "2.5", "x", "NaN"]),
            }
            for _ in range(400)
        ),
    )
    direct = df.agg(
        F.avg(F.expr("nullif(try_cast(Discharges as double), double('NaN'))")),
        F.countDistinct("provider_id"),
        F.countDistinct("state"),
    ).first()
    got = kpis(df, "Discharges").first()
    assert math.isclose(got[0], direct[0]) and got[1:] == direct[1:]


def test_kpis_of_nothing(sample):
    none = filter_rows(sample, ["ZZ"])
    assert kpis(none, "R Rate Diff").collect() == [(None, 0, 0)]
    assert kpi_labels(none, "R Rate Diff").collect() == [("N/A", 0, 0)]
    assert kpi_labels(sample, "R Rate Diff").collect() == [("4.00", 3, 2)]


def test_group_means_are_descending_without_the_null_group(sample):
    assert [tuple(r) for r in mean_by(sample, "Hosp Ownership", "R Rate Diff").collect()] == [
        ("Tribal", 7.0),
        ("Local", 6.0),
        ("Prop", 1.5),
    ]
    # A group without a number stays, last.
    assert [tuple(r) for r in mean_by(sample, "Hosp Rating", "R Rate Diff").collect()] == [
        ("2 Star", 6.0),
        ("1 Star", 1.5),
        ("3 Star", None),
    ]


def test_state_means_are_in_state_order(sample):
    assert [tuple(r) for r in mean_by_state(sample, "Discharges").collect()] == [
        ("AK", 10.0),
        ("TX", 20.0),
    ]


def test_choices_are_checked(sample):
    with pytest.raises(UnknownOption):
        mean_by(sample, "state", "R Rate Diff")
    with pytest.raises(UnknownOption):
        kpis(sample, "provider_id")
    with pytest.raises(MissingColumns):
        kpis(sample.drop("R Rate Diff"), "R Rate Diff")
    with pytest.raises(MissingColumns):
        mean_by(sample.drop("Hosp Rating"), "Hosp Rating", "R Rate Diff")
    with pytest.raises(UnknownOption):
        histogram(sample, "R Rate Diff", mode="round")


# --- histogram ---


def values_frame(spark, values):
    return gold_rows(spark, *({"R Rate Diff": v} for v in values))


def brute_exact(values, bins=20):
    values = [v for v in values if v is not None and math.isfinite(v)]
    lo, hi = min(values), max(values)
    width = (hi - lo) / bins
    counts = {}
    for v in values:
        b = min(math.floor((v - lo) / width), bins - 1) if width > 0 else 0
        counts[b] = counts.get(b, 0) + 1
    return sorted((b, lo + b * width if width > 0 else lo, n) for b, n in counts.items())


@pytest.mark.parametrize("seed", range(4))
def test_exact_histogram_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    values = [round(rng.uniform(-3, 9), seed) for _ in range(300)] + [None, float("nan")]
    got = [tuple(r) for r in histogram(values_frame(spark, values), "R Rate Diff").collect()]
    assert got == brute_exact(values)


def test_maximum_falls_into_the_last_bin(spark):
    got = histogram(values_frame(spark, [0.0, 20.0]), "R Rate Diff").collect()
    assert [(r.bin, r.n) for r in got] == [(0, 1), (19, 1)]


@pytest.mark.parametrize("mode", ["exact", "nice"])
@pytest.mark.parametrize("dense", [False, True])
def test_constant_and_empty_columns(spark, mode, dense):
    constant = histogram(
        values_frame(spark, [3.0, 3.0, None]), "R Rate Diff", mode=mode, dense=dense
    )
    assert [tuple(r) for r in constant.collect()] == [(0, 3.0, 2)]
    nothing = histogram(values_frame(spark, [None, None]), "R Rate Diff", mode=mode, dense=dense)
    assert nothing.collect() == []


def test_infinite_values_have_no_bin(spark):
    values = [0.0, 1.0, float("inf"), float("-inf")]
    assert sum(r.n for r in histogram(values_frame(spark, values), "R Rate Diff").collect()) == 2


def test_nice_widths(spark):
    df = values_frame(spark, [float(v) for v in range(-27, 28)])
    got = histogram(df, "R Rate Diff", mode="nice").collect()
    assert [r.bin_start for r in got] == [float(v) for v in range(-30, 30, 5)]
    assert [r.bin for r in got] == list(range(12))
    assert sum(r.n for r in got) == 55


@pytest.mark.parametrize("scale", [1e-6, 0.013, 1.0, 37.0, 1e9])
@pytest.mark.parametrize("offset", [-0.97, 0.0, 0.4])
def test_nice_histogram_has_few_round_bins_and_all_rows(spark, scale, offset):
    values = [(n / 100 + offset) * scale for n in range(101)]
    got = histogram(values_frame(spark, values), "R Rate Diff", mode="nice").collect()
    assert sum(r.n for r in got) == 101
    assert 2 <= len(got) <= 20 and got[-1].bin < 20
    width = got[1].bin_start - got[0].bin_start
    digits = round(width / 10 ** math.floor(math.log10(width * 1.000001)), 6)
    assert digits in (1, 2, 5)


def test_dense_histogram_has_every_bin(spark):
    df = values_frame(spark, [0.0, 10.0, 10.0])
    got = histogram(df, "R Rate Diff", dense=True).collect()
    assert [r.bin for r in got] == list(range(20))
    assert [r.bin_start for r in got] == [n * 0.5 for n in range(20)]
    assert [r.n for r in got] == [1] + [0] * 18 + [2]


def test_histogram_joins_nothing_and_counts_partially(sample):
    plan = physical_plan_of(histogram(sample, "R Rate Diff"))
    assert "Join" not in plan and "partial_count" in plan


# --- dashboard ---


@pytest.fixture(scope="module")
def gold_path(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("gold") / "t")
    write_gold(
        gold_rows(
            spark,
            *(
                {
                    "provider_id": n,
                    "state": f"S{n % 4}",
                    "Readm Type": ["AMI", "COPD"][n % 2],
                    "Hosp Ownership": "Prop",
                    "Hosp Rating": "1 Star",
                    "R Rate Diff": float(n),
                }
                for n in range(40)
            ),
        ),
        folder,
    )
    return folder


def test_dashboard(spark, gold_path):
    out = dashboard(
        read_gold(spark, gold_path),
        states=["S1", "S2"],
        readm_types=["AMI"],
        group_by="Hosp Rating",
    )
    assert [r[0] for r in out["states"].collect()] == ["S0", "S1", "S2", "S3"]
    assert [r[0] for r in out["readm_types"].collect()] == ["AMI", "COPD"]
    assert out["rows"].count() == 10
    assert out["kpis"].collect() == [(20.0, 10, 1)]
    assert out["kpi_labels"].collect() == [("20.00", 10, 1)]
    assert [tuple(r) for r in out["mean_by_group"].collect()] == [("1 Star", 20.0)]
    assert rows(out["mean_by_state"]) == [("S2", 20.0)]
    assert sum(r.n for r in out["histogram"].collect()) == 10


def test_dashboard_prunes_partitions_and_columns(spark, gold_path):
    out = dashboard(read_gold(spark, gold_path), states=["S1"])
    plan = out["mean_by_group"]._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(state" in scan
    assert "ReadSchema: struct<Hosp Ownership:string,R Rate Diff:double>" in scan


CHOICES = [{}, {"states": ["AK", "TX"]}, {"readm_types": ["AMI"]}, {"states": ["TX"], "readm_types": ["AMI"]}, {"states": ["none"]}]


@pytest.mark.parametrize("choices", CHOICES)
@pytest.mark.parametrize("group", ["Hosp Rating", "Hosp Ownership"])
def test_views_of_a_summary_equal_those_of_gold(spark, sample, tmp_path, choices, group):
    write_summary(sample, str(tmp_path / "s"))
    summary = read_summary(spark, str(tmp_path / "s"))
    for metric in ("R Rate Diff", "Discharges"):
        plain = dashboard(sample, group_by=group, metric=metric, **choices)
        short = dashboard(sample, group_by=group, metric=metric, summary=summary, **choices)
        for view in plain:
            assert short[view].columns == plain[view].columns
            assert short[view].dtypes == plain[view].dtypes
            assert short[view].collect() == plain[view].collect()


def test_facility_keys_of_any_sign_and_size_are_counted_exactly(spark):
    keys = [0, 1, -1, 32768, 32769, -32768, -32769, 1 << 40, -(1 << 40), 7, None]
    items = [{"provider_id": k, "state": s} for k in keys for s in ("a", "b", "b")]
    df = gold_rows(spark, *items)
    sums = totals(summarise(df), "Hosp Rating", "R Rate Diff")
    assert kpis_of(sums).collect() == kpis(df, "R Rate Diff").collect() == [(None, 10, 2)]


def test_kpis_and_means_come_from_one_scan(spark, gold_path, tmp_path):
    df = read_gold(spark, gold_path)
    assert physical_plan_of(totals(summarise(df), "Hosp Rating", "R Rate Diff")).count("FileScan") == 1
    write_summary(df, str(tmp_path / "s"))
    short = dashboard(df, states=["S1"], summary=read_summary(spark, str(tmp_path / "s")))
    for view in ("kpis", "kpi_labels", "mean_by_group", "mean_by_state"):
        plan = physical_plan_of(short[view])
        assert plan.count("FileScan") == 1 and gold_path not in plan
        assert "Readm Type" not in plan.split("ReadSchema:")[1]


def test_summaries_are_made_and_read_without_a_sort(spark, gold_path):
    plan = physical_plan_of(totals(summarise(read_gold(spark, gold_path)), "Hosp Rating", "R Rate Diff"))
    assert "SortAggregate" not in plan and "Sort [" not in plan and "HashAggregate" in plan


def test_bad_choices_raise(sample):
    with pytest.raises(UnknownOption):
        filter_rows(sample, "AK")
    with pytest.raises(UnknownOption):
        filter_rows(sample, [], "AMI")
    with pytest.raises(UnknownOption):
        histogram(sample, "R Rate Diff", bins=0)
    with pytest.raises(UnknownOption):
        histogram(sample, "provider_id")
