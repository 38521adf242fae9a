"""Declared schemas, column lists and recode tables of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: column names, types and order are part of the data contract ---

GEN_INFO = T.StructType()
for _name, _type in [
    ("provider id", T.IntegerType()),
    ("hospital name", T.StringType()),
    ("address", T.StringType()),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("zip code", T.IntegerType()),
    ("county name", T.StringType()),
    ("phone number", T.LongType()),
    ("hospital type", T.StringType()),
    ("hospital ownership", T.StringType()),
    ("emergency services", T.BooleanType()),
    ("meets criteria for meaningful use of ehrs", T.BooleanType()),
    ("hospital overall rating", T.StringType()),
    ("hospital overall rating footnote", T.StringType()),
    ("mortality national comparison", T.StringType()),
    ("mortality national comparison footnote", T.StringType()),
    ("safety of care national comparison", T.StringType()),
    ("safety of care national comparison footnote", T.StringType()),
    ("readmission national comparison", T.StringType()),
    ("readmission national comparison footnote", T.StringType()),
    ("patient experience national comparison", T.StringType()),
    ("patient experience national comparison footnote", T.StringType()),
    ("effectiveness of care national comparison", T.StringType()),
    ("effectiveness of care national comparison footnote", T.StringType()),
    ("timeliness of care national comparison", T.StringType()),
    ("timeliness of care national comparison footnote", T.StringType()),
    ("efficient use of medical imaging national comparison", T.StringType()),
    ("efficient use of medical imaging national comparison footnote", T.StringType()),
    ("location", T.StringType()),
]:
    GEN_INFO.add(_name, _type)

READMISSIONS = T.StructType()
for _name in [
    "Hospital Name",
    "Provider ID",
    "State",
    "Measure Name",
    "Number of Discharges",
    "Footnote",
    "Excess Readmission Ratio",
    "Predicted Readmission Rate",
    "Expected Readmission Rate",
    "Number of Readmissions",
    "Start Date",
    "End Date",
]:
    READMISSIONS.add(_name, T.IntegerType() if _name == "Provider ID" else T.StringType())

GOLD = T.StructType()
for _name, _type in [
    ("state", T.StringType()),
    ("provider_id", T.LongType()),
    ("Readm Type", T.StringType()),
    ("Discharges", T.StringType()),
    ("Readmissions", T.StringType()),
    ("Excess Readm Ratio", T.StringType()),
    ("Pred Readm Rate", T.StringType()),
    ("Exp Readm Rate", T.StringType()),
    ("Hosp Ownership", T.StringType()),
    ("Hosp Rating", T.StringType()),
    ("R Rate Diff", T.DoubleType()),
]:
    GOLD.add(_name, _type)

# Alternate raw CSV header names and the canonical name of each.
ALTERNATE_HEADERS = {
    "hospital_name#0": "Hospital Name",
    "provider_id#1": "Provider ID",
    "measure_name#2": "Measure Name",
    "number_of_discharges#3": "Number of Discharges",
    "excess_readmission_ratio#4": "Excess Readmission Ratio",
    "predicted_readmission_rate#5": "Predicted Readmission Rate",
    "expected_readmission_rate#6": "Expected Readmission Rate",
    "number_of_readmissions#7": "Number of Readmissions",
    "start_date#8": "Start Date",
    "end_date#9": "End Date",
}

# Text that stands for null.
SENTINEL = "Not Available"

READM_TYPES = {
    "READM_30_PN_HRRP": "Pneumonia",
    "READM_30_AMI_HRRP": "AMI",
    "READM_30_COPD_HRRP": "COPD",
    "READM_30_CABG_HRRP": "CABG",
    "READM_30_HF_HRRP": "Heart_Failure",
    "READM_30_HIP_KNEE_HRRP": "Hip_Knee",
}

OWNERSHIPS = {
    "Voluntary non-profit - Private": "Pvt NP",
    "Proprietary": "Prop",
    "Voluntary non-profit - Other": "Other",
    "Voluntary non-profit - Church": "Church",
    "Government - Hospital District or Authority": "Hospital",
    "Government - Local": "Local",
    "Government - State": "State",
    "Physician": "Physician",
    "Government - Federal": "Federal",
    "Tribal": "Tribal",
}

RATINGS = {
    "1": "1 Star",
    "2": "2 Star",
    "3": "3 Star",
    "4": "4 Star",
    "5": "5 Star",
}

# Columns an analyst may group by, and columns an analyst may measure.
GROUP_OPTIONS = ["Hosp Ownership", "Hosp Rating"]
METRIC_OPTIONS = [
    "R Rate Diff",
    "Excess Readm Ratio",
    "Exp Readm Rate",
    "Pred Readm Rate",
    "Discharges",
    "Readmissions",
]

HISTOGRAM_BINS = 20

PARTITION_COLUMN = "state"

# Gold column -> Silver column, for each Silver table (the key is handled apart).
FACILITY_COLUMNS = {
    "Hosp Ownership": "hospital ownership",
    "Hosp Rating": "hospital overall rating",
}
MEASURE_COLUMNS = {
    "state": "State",
    "Readm Type": "Measure Name",
    "Discharges": "Number of Discharges",
    "Readmissions": "Number of Readmissions",
    "Excess Readm Ratio": "Excess Readmission Ratio",
    "Pred Readm Rate": "Predicted Readmission Rate",
    "Exp Readm Rate": "Expected Readmission Rate",
}

# A Gold row needs all of these.
REQUIRED_MEASURE_COLUMNS = ["state", "Readm Type", "Pred Readm Rate", "Exp Readm Rate"]
REQUIRED_FACILITY_COLUMNS = ["Hosp Ownership", "Hosp Rating"]

# --- End of fixed values ---

OPTIONAL_COLUMNS = [c for c in MEASURE_COLUMNS if c not in REQUIRED_MEASURE_COLUMNS]
REQUIRED_COLUMNS = REQUIRED_MEASURE_COLUMNS + REQUIRED_FACILITY_COLUMNS

# Raw measure columns without which no Gold table can be built.
REQUIRED_RAW_MEASURES = ["Provider ID", *MEASURE_COLUMNS.values()]
