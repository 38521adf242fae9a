"""Small hand-written frames and helpers for the tests."""

from __future__ import annotations

from medallion.schemas import GEN_INFO, GOLD, READMISSIONS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(left, right) -> bool:
    assert left.columns == right.columns
    return rows(left) == rows(right)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def physical_plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def facility(key, ownership="Proprietary", rating="3", **other):
    row = dict.fromkeys(GEN_INFO.names)
    row |= {
        "provider id": key,
        "hospital ownership": ownership,
        "hospital overall rating": rating,
        **other,
    }
    return tuple(row[c] for c in GEN_INFO.names)


def measure(key, state="AK", name="READM_30_HF_HRRP", pred="16.1", exp="15.7", **other):
    row = dict.fromkeys(READMISSIONS.names)
    row |= {
        "Provider ID": key,
        "State": state,
        "Measure Name": name,
        "Predicted Readmission Rate": pred,
        "Expected Readmission Rate": exp,
        **{k.replace("_", " "): v for k, v in other.items()},
    }
    return tuple(row[c] for c in READMISSIONS.names)


def facilities(spark, *items):
    return spark.createDataFrame(list(items), GEN_INFO)


def measures(spark, *items):
    return spark.createDataFrame(list(items), READMISSIONS)


def gold_rows(spark, *items):
    """Gold rows from dicts; columns not named are null, but for the state and the key."""
    filled = []
    for n, item in enumerate(items):
        row = {**dict.fromkeys(GOLD.names), "state": "AK", "provider_id": n, **item}
        filled.append(tuple(row[c] for c in GOLD.names))
    return spark.createDataFrame(filled, GOLD)
