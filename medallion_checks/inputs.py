"""Facility and measure inputs derived from the given tables.

The given tables hold no facility data, so both inputs are computed from every row of `customer`
and `orders`, with integer and string operations only: Spark and DuckDB then agree exactly. Some
rows get a null key, a null state or the sentinel, so every rule of the pipeline has work to do.
The text below is ANSI SQL; Spark quotes names with backticks instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.schemas import GEN_INFO, READMISSIONS

_ENDING = " national comparison"
_TOPICS = [n.removesuffix(_ENDING) for n in GEN_INFO.names if n.endswith(_ENDING)]


def _comparison(number: int, topic: str) -> str:
    pick = f"(c_custkey + {number}) % 4"
    return (
        f"case {pick} when 0 then 'Above the national average' "
        f"when 1 then 'Same as the national average' "
        f"when 2 then 'Below the national average' else 'Not Available' end "
        f'as "{topic} national comparison", '
        f"case when {pick} = 3 then 'Results are not available, see note' end "
        f'as "{topic} national comparison footnote"'
    )


FACILITIES = f"""
select
  case when c_custkey % 17 = 0 then null else c_custkey end as "provider id",
  c_name as "hospital name",
  concat(cast(c_custkey % 900 + 100 as varchar(5)), ' ', c_mktsegment, ' STREET') as "address",
  concat('CITY ', cast(c_nationkey as varchar(5))) as "city",
  concat('S', cast(c_custkey % 50 as varchar(3))) as "state",
  cast(10000 + c_custkey % 89999 as int) as "zip code",
  case when c_custkey % 23 = 0 then null else concat('COUNTY ', c_mktsegment) end as "county name",
  2000000000 + c_custkey as "phone number",
  case c_custkey % 3 when 0 then 'Acute Care' when 1 then 'Critical Access' else 'Childrens' end
    as "hospital type",
  case c_nationkey % 10 when 0 then 'Voluntary non-profit - Private' when 1 then 'Proprietary'
    when 2 then 'Voluntary non-profit - Other' when 3 then 'Voluntary non-profit - Church'
    when 4 then 'Government - Hospital District or Authority' when 5 then 'Government - Local'
    when 6 then 'Government - State' when 7 then 'Physician' when 8 then 'Government - Federal'
    else 'Tribal' end as "hospital ownership",
  c_custkey % 4 <> 0 as "emergency services",
  case when c_custkey % 5 = 0 then null else c_custkey % 2 = 0 end
    as "meets criteria for meaningful use of ehrs",
  case when c_custkey % 6 = 0 then 'Not Available' else cast(c_custkey % 6 as varchar(2)) end
    as "hospital overall rating",
  case when c_custkey % 6 = 0 then 'Too few measures' end as "hospital overall rating footnote",
  {", ".join(_comparison(n, t) for n, t in enumerate(_TOPICS))},
  concat('(', cast(c_custkey % 90 as varchar(5)), ', -', cast(c_custkey % 180 as varchar(5)), ')')
    as "location"
from customer
"""

MEASURES = """
select
  concat('Facility ', cast(o_custkey as varchar(20))) as "Hospital Name",
  case when o_custkey % 19 = 0 then null else o_custkey end as "Provider ID",
  case when o_orderkey % 29 = 0 then null
    else concat('S', cast(o_custkey % 50 as varchar(3))) end as "State",
  case o_orderpriority when '1-URGENT' then 'READM_30_PN_HRRP'
    when '2-HIGH' then 'READM_30_AMI_HRRP'
    when '3-MEDIUM' then 'READM_30_COPD_HRRP' when '4-NOT SPECIFIED' then 'READM_30_CABG_HRRP'
    else (case when o_orderkey % 2 = 0 then 'READM_30_HF_HRRP' else 'READM_30_HIP_KNEE_HRRP' end)
    end as "Measure Name",
  case when o_orderkey % 11 = 0 then 'Not Available'
    else cast(o_orderkey % 997 as varchar(5)) end as "Number of Discharges",
  case when o_orderkey % 7 = 0 then 'Reason: "small", see note' end as "Footnote",
  case when o_orderkey % 7 = 0 then 'Not Available'
    else concat('1.', lpad(cast(o_orderkey % 1000 as varchar(4)), 3, '0')) end
    as "Excess Readmission Ratio",
  case when o_orderkey % 7 = 0 then 'Not Available'
    else concat(cast(cast(floor((o_orderkey * 7919 % 300 + 100) / 10) as int) as varchar(5)), '.',
                cast(o_orderkey * 7919 % 10 as varchar(2))) end as "Predicted Readmission Rate",
  case when o_orderkey % 7 = 0 then 'Not Available'
    else concat(cast(cast(floor((o_orderkey * 104729 % 300 + 100) / 10) as int) as varchar(5)), '.',
                cast(o_orderkey * 104729 % 10 as varchar(2))) end as "Expected Readmission Rate",
  case when o_orderkey % 13 = 0 then 'Too Few to Report'
    else cast(o_orderkey % 89 as varchar(5)) end as "Number of Readmissions",
  case when o_orderkey % 2 = 0 then '07/01/2010' else '07/01/2011' end as "Start Date",
  case when o_orderkey % 2 = 0 then '06/30/2013' else '06/30/2014' end as "End Date"
from orders
"""


def _with_long_key(schema: T.StructType, key: str) -> T.StructType:
    # The given keys are longs and outgrow the declared INT at scale.
    return T.StructType(
        [T.StructField(f.name, T.LongType()) if f.name == key else f for f in schema]
    )


FACILITY_SCHEMA = _with_long_key(GEN_INFO, "provider id")
MEASURE_SCHEMA = _with_long_key(READMISSIONS, "Provider ID")

# The columns read from each given table.
_SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
}


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", FACILITIES)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "orders", MEASURES)


def _derive(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    source = spark.read.schema(_SOURCES[table]).parquet(f"{sf_dir}/{table}.parquet")
    # The quoted word inside a value keeps its double quotes.
    quoted = sql.replace('"small"', "\0").replace('"', "`").replace("\0", '"small"')
    return spark.sql(quoted.replace(f"from {table}", f"from {{{table}}}"), **{table: source})
