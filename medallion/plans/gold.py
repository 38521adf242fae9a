"""The Gold transform: project, join, clean, recode, derive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.clean import (
    key_as_long,
    null_sentinel,
    rate_diff,
    recode,
    require_present,
)
from medallion.operators.joins import join_facilities, right_join_facilities
from medallion.schemas import (
    FACILITY_COLUMNS,
    GOLD,
    MEASURE_COLUMNS,
    OPTIONAL_COLUMNS,
    OWNERSHIPS,
    RATINGS,
    READM_TYPES,
    REQUIRED_FACILITY_COLUMNS,
    REQUIRED_MEASURE_COLUMNS,
)

KEY = "provider_id"


def project_facility(gen_info: DataFrame) -> DataFrame:
    """Key, ownership and rating of a facility."""
    return _project(gen_info, "provider id", FACILITY_COLUMNS)


def project_measures(readmissions: DataFrame) -> DataFrame:
    """Key, state, type, counts and rates of a measure."""
    return _project(readmissions, "Provider ID", MEASURE_COLUMNS)


def merged(readmissions: DataFrame, gen_info: DataFrame, **join_options) -> DataFrame:
    """Every facility with its measures, nothing cleaned: key, measure and facility columns."""
    return right_join_facilities(
        project_measures(readmissions), project_facility(gen_info), KEY, **join_options
    )


def usable_facilities(gen_info: DataFrame) -> DataFrame:
    """The facilities that can be in Gold."""
    return require_present(project_facility(gen_info), REQUIRED_FACILITY_COLUMNS)


def gold(readmissions: DataFrame, gen_info: DataFrame, **join_options) -> DataFrame:
    """Gold rows: facilities right-joined to measures, sentinel nulled, required columns present.

    A facility without measures lacks required columns, so the right join is an inner one here.
    The required columns are tested on the raw values, below the join, and reach the Parquet scan;
    after that only the optional columns can still hold the sentinel.
    """
    measures = require_present(project_measures(readmissions), REQUIRED_MEASURE_COLUMNS)
    joined = join_facilities(measures, usable_facilities(gen_info), KEY, **join_options)
    return labelled(null_sentinel(joined, OPTIONAL_COLUMNS))


def labelled(df: DataFrame) -> DataFrame:
    """Recode the three coded columns, add the rate difference, order the columns."""
    labels = {"Readm Type": READM_TYPES, "Hosp Ownership": OWNERSHIPS, "Hosp Rating": RATINGS}
    diff = rate_diff("Pred Readm Rate", "Exp Readm Rate")
    return recode(df, labels).withColumn("R Rate Diff", diff).select(GOLD.names)


def _project(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return df.select(
        key_as_long(key).alias(KEY),
        *(F.col(f"`{source}`").alias(name) for name, source in columns.items()),
    )
