from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import rows
from medallion import schemas
from medallion.functions import clean
from medallion.schemas import OWNERSHIPS, RATINGS, READM_TYPES


def test_sentinel_becomes_null_in_string_columns_only_and_exactly(spark):
    df = spark.createDataFrame(
        [("Not Available", 1), ("Not Available ", 2), ("not available", 3), ("x", 4), (None, 5)],
        "a string, n int",
    )
    assert rows(clean.null_sentinel(df)) == rows(
        spark.createDataFrame(
            [(None, 1), ("Not Available ", 2), ("not available", 3), ("x", 4), (None, 5)],
            "a string, n int",
        )
    )


def test_sentinel_in_chosen_columns(spark):
    df = spark.createDataFrame([("Not Available", "Not Available")], "a string, b string")
    assert rows(clean.null_sentinel(df, ["b"])) == [("Not Available", None)]


def test_require_keeps_rows_with_all_columns(spark):
    df = spark.createDataFrame([("x", 1), (None, 1), ("x", None)], "a string, `b c` int")
    assert rows(clean.require(df, ["a", "b c"])) == [("x", 1)]


def test_require_present_equals_sentinel_then_require(spark):
    df = spark.createDataFrame(
        [("x", "y"), ("Not Available", "y"), (None, "y"), ("x", "Not Available")],
        "a string, b string",
    )
    expected = clean.require(clean.null_sentinel(df), ["a", "b"])
    assert rows(clean.require_present(df, ["a", "b"])) == rows(expected) == [("x", "y")]


def test_recode_is_one_pass_and_keeps_unmapped_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    out = clean.recode(df, {"v": {"a": "b", "b": "c"}})
    assert rows(out) == rows(spark.createDataFrame([("b",), ("c",), ("z",), (None,)], "v string"))


@pytest.mark.parametrize("mapping", [READM_TYPES, OWNERSHIPS, RATINGS])
def test_recode_tables(spark, mapping):
    values = [*mapping, "Department of Defense", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = clean.recode(df, {"v": mapping}).collect()
    assert [r.v for r in out] == [mapping.get(v, v) for v in values]


def test_key_as_long(spark):
    df = spark.createDataFrame([("010001",), ("x",), (None,), ("9999999999",)], "k string")
    keys = df.select(clean.key_as_long("k").alias("k"))
    assert rows(keys) == rows(
        spark.createDataFrame([(10001,), (None,), (None,), (9999999999,)], "k long")
    )


def test_rate_diff_is_float_arithmetic_in_a_double(spark):
    df = spark.createDataFrame(
        [("16.1", "15.7"), ("Too Few to Report", "1.0"), (None, "1.0"), ("2.5", None)],
        "p string, e string",
    )
    out = df.select(clean.rate_diff("p", "e").alias("d"))
    assert out.schema["d"].dataType.simpleString() == "double"
    assert [r.d for r in out.collect()] == [0.40000057220458984, None, None, None]


def test_metric_value_ignores_text_and_nan(spark):
    df = spark.createDataFrame([("1.5",), ("Too Few",), ("NaN",), (None,)], "m string")
    assert [r.v for r in df.select(clean.metric_value("m").alias("v")).collect()] == [
        1.5,
        None,
        None,
        None,
    ]


def test_kpi_label(spark):
    numbers = spark.createDataFrame(
        [(x,) for x in (1.234, None, float("nan"), -2.0, 2.675, 0.125, 1.005, -0.001, 12345.678)],
        "x double",
    )
    labels = [r.v for r in numbers.select(clean.kpi_label(F.col("x")).alias("v")).collect()]
    assert labels == [
        "1.23", "N/A", "N/A", "-2.00", "2.67", "0.12", "1.00", "-0.00", "12345.68",
    ]
    text = spark.createDataFrame([("7",), ("many",)], "x string")
    labels = [r.v for r in text.select(clean.kpi_label(F.col("x")).alias("v")).collect()]
    assert labels == ["7.00", "many"]


def test_contract_values_as_literals():
    """The fixed tables, written out once more, so that the SQL comparison is independent of them."""
    assert schemas.READM_TYPES == {
        "READM_30_PN_HRRP": "Pneumonia",
        "READM_30_AMI_HRRP": "AMI",
        "READM_30_COPD_HRRP": "COPD",
        "READM_30_CABG_HRRP": "CABG",
        "READM_30_HF_HRRP": "Heart_Failure",
        "READM_30_HIP_KNEE_HRRP": "Hip_Knee",
    }
    assert schemas.OWNERSHIPS["Government - Hospital District or Authority"] == "Hospital"
    assert schemas.OWNERSHIPS["Voluntary non-profit - Private"] == "Pvt NP"
    assert list(schemas.OWNERSHIPS.values()) == [
        "Pvt NP", "Prop", "Other", "Church", "Hospital", "Local", "State", "Physician", "Federal",
        "Tribal",
    ]
    assert schemas.RATINGS == {str(n): f"{n} Star" for n in range(1, 6)}
    assert schemas.ALTERNATE_HEADERS["expected_readmission_rate#6"] == "Expected Readmission Rate"
    assert len(schemas.ALTERNATE_HEADERS) == 10
    assert schemas.SENTINEL == "Not Available"
    assert schemas.REQUIRED_COLUMNS == [
        "state", "Readm Type", "Pred Readm Rate", "Exp Readm Rate", "Hosp Ownership", "Hosp Rating",
    ]
    assert len(schemas.GEN_INFO) == 29 and schemas.GEN_INFO.names[-1] == "location"
    assert schemas.GEN_INFO.names[14] == "mortality national comparison"
