from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from frames import facilities, facility, measure, measures, physical_plan_of, rows
from medallion.functions import clean
from medallion.plans.gold import (
    KEY,
    gold,
    labelled,
    merged,
    project_facility,
    project_measures,
)
from medallion.schemas import GOLD, REQUIRED_COLUMNS

WAYS = [{}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "rows_per_task": 2}]


def naive(readmissions, gen_info):
    joined = project_measures(readmissions).join(project_facility(gen_info), KEY, "right")
    return labelled(clean.null_sentinel(joined).dropna(subset=REQUIRED_COLUMNS))


def test_one_row_in_full(spark):
    readmissions = measures(
        spark,
        measure(
            7,
            Number_of_Discharges="Not Available",
            Number_of_Readmissions="Too Few to Report",
            Excess_Readmission_Ratio="1.01",
        ),
    )
    out = gold(readmissions, facilities(spark, facility(7)))
    assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in GOLD]
    assert rows(out) == [
        (
            "AK",
            7,
            "Heart_Failure",
            None,
            "Too Few to Report",
            "1.01",
            "16.1",
            "15.7",
            "Prop",
            "3 Star",
            0.40000057220458984,
        )
    ]


@pytest.mark.parametrize(
    ("m", "f"),
    [
        (measure(7, pred="Not Available"), facility(7)),
        (measure(7, exp=None), facility(7)),
        (measure(7, state=None), facility(7)),
        (measure(7, name="Not Available"), facility(7)),
        (measure(7), facility(7, rating="Not Available")),
        (measure(7), facility(7, ownership=None)),
        (measure(7), facility(8)),
        (measure(None), facility(None)),
    ],
)
def test_rows_without_a_required_value_are_dropped(spark, m, f):
    assert gold(measures(spark, m), facilities(spark, f)).isEmpty()


def test_values_that_are_kept(spark):
    readmissions = measures(
        spark,
        measure(1, state="Not Available "),
        measure(1, name="UNKNOWN", pred="Too Few to Report"),
    )
    out = gold(readmissions, facilities(spark, facility(1, "Department of Defense", "6")))
    got = {(r["state"], r["Readm Type"], r["R Rate Diff"]) for r in out.collect()}
    assert got == {
        ("Not Available ", "Heart_Failure", 0.40000057220458984),
        ("AK", "UNKNOWN", None),
    }
    assert {(r["Hosp Ownership"], r["Hosp Rating"]) for r in out.collect()} == {
        ("Department of Defense", "6")
    }


def test_repeated_facility_repeats_its_measures(spark):
    out = gold(measures(spark, measure(1)), facilities(spark, facility(1), facility(1)))
    assert out.count() == 2


def test_facility_without_measures_is_in_the_merge_but_not_in_gold(spark):
    readmissions, gen_info = measures(spark, measure(1)), facilities(spark, facility(2))
    assert [r[KEY] for r in merged(readmissions, gen_info).collect()] == [2]
    assert gold(readmissions, gen_info).isEmpty()


def test_pushed_down_form_equals_the_plain_one_on_random_rows(spark):
    rng = random.Random(11)
    text = ["Not Available", "Not Available ", None, "x", "3", "16.1", "Too Few to Report"]
    keys = [None, 1, 2, 3, 4, 5]
    readmissions = measures(
        spark,
        *(
            measure(
                rng.choice(keys),
                rng.choice(text),
                rng.choice([*text, "READM_30_HF_HRRP"]),
                rng.choice(text),
                rng.choice(text),
                Number_of_Discharges=rng.choice(text),
                Number_of_Readmissions=rng.choice(text),
                Excess_Readmission_Ratio=rng.choice(text),
            )
            for _ in range(1500)
        ),
    )
    gen_info = facilities(
        spark,
        *(
            facility(rng.choice(keys), rng.choice([*text, "Tribal"]), rng.choice([*text, "1"]))
            for _ in range(40)
        ),
    )
    expected = rows(naive(readmissions, gen_info))
    assert len(expected) > 500
    for options in WAYS:
        assert rows(gold(readmissions, gen_info, **options)) == expected


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("silver"))
    measures(spark, measure(1), measure(2)).write.parquet(f"{folder}/m")
    facilities(spark, facility(1), facility(2)).write.parquet(f"{folder}/f")
    return spark.read.parquet(f"{folder}/m"), spark.read.parquet(f"{folder}/f")


def test_plan_is_one_broadcast_inner_join_without_shuffle(silver):
    plan = physical_plan_of(gold(*silver))
    assert "BroadcastHashJoin" in plan and ", Inner, BuildRight" in plan
    assert "Exchange hashpartitioning" not in plan and "atleastnnonnulls" not in plan


def test_required_columns_and_pruning_reach_both_scans(silver):
    plan = gold(*silver)._jdf.queryExecution().executedPlan().treeString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    measure_scan, facility_scan = scans
    assert "Footnote" not in measure_scan and "Start Date" not in measure_scan
    assert "IsNotNull(State)" in measure_scan or "isnotnull(State" in measure_scan
    assert "hospital name" not in facility_scan and "location#" not in facility_scan
    pushed = spark_pushed(gold(*silver))
    for column in ("State", "`Measure Name`", "`Predicted Readmission Rate`"):
        assert f"IsNotNull({column})" in pushed
        assert f"Not(EqualTo({column},Not Available))" in pushed
    assert "Not(EqualTo(`hospital overall rating`,Not Available))" in pushed


def spark_pushed(df) -> str:
    formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return "\n".join(line for line in formatted.splitlines() if line.startswith("PushedFilters"))


def test_plain_form_keeps_the_outer_join(silver):
    # The reason for stating the requirement below the join.
    assert "RightOuter" in physical_plan_of(naive(*silver))


def test_state_filter_on_gold_reaches_the_measure_scan(silver):
    df = gold(*silver).filter(F.col("state") == "AK")
    assert "EqualTo(State,AK)" in spark_pushed(df)
