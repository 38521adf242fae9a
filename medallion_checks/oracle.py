"""DuckDB SQL for each registered query, over the same derived inputs."""

from __future__ import annotations

from medallion.schemas import (
    FACILITY_COLUMNS,
    GEN_INFO,
    GOLD,
    MEASURE_COLUMNS,
    OWNERSHIPS,
    RATINGS,
    READM_TYPES,
    READMISSIONS,
    REQUIRED_COLUMNS,
    SENTINEL,
)
from medallion_checks.inputs import FACILITIES, MEASURES


def snake(name: str) -> str:
    return name.lower().replace(" ", "_")


def _typed(schema, alias: str, *, as_declared: bool) -> str:
    types = {"int": "integer", "bigint": "bigint", "string": "varchar", "boolean": "boolean"}
    return ", ".join(
        f'try_cast({alias}."{f.name}" as {types[f.dataType.simpleString()]}) as {snake(f.name)}'
        if as_declared
        else f'{alias}."{f.name}" as {snake(f.name)}'
        for f in schema
    )


def _case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when '{old}' then '{new}'" for old, new in mapping.items())
    return f"case {column} {whens} else {column} end"


_PARTIAL = [f for f in READMISSIONS if f.name not in ("State", "Footnote")]

_INPUTS = f"with gi as ({FACILITIES}), rd as ({MEASURES})"

_MEASURE_LIST = ", ".join(f'rd."{src}" as {snake(name)}' for name, src in MEASURE_COLUMNS.items())
_FACILITY_LIST = ", ".join(f'gi."{src}" as {snake(name)}' for name, src in FACILITY_COLUMNS.items())
_TEXT = [snake(c) for c in [*MEASURE_COLUMNS, *FACILITY_COLUMNS]]

_CHAIN = f"""{_INPUTS},
joined as (
  select cast(gi."provider id" as bigint) as provider_id, {_MEASURE_LIST}, {_FACILITY_LIST}
  from rd right join gi on rd."Provider ID" = gi."provider id"),
nulled as (
  select provider_id, {", ".join(f"nullif({c}, '{SENTINEL}') as {c}" for c in _TEXT)}
  from joined),
kept as (
  select * from nulled
  where {" and ".join(f"{snake(c)} is not null" for c in REQUIRED_COLUMNS)})"""

_GOLD = f"""{_CHAIN},
gold as (
  select state, provider_id,
    {_case("readm_type", READM_TYPES)} as readm_type, discharges, readmissions,
    excess_readm_ratio, pred_readm_rate, exp_readm_rate,
    {_case("hosp_ownership", OWNERSHIPS)} as hosp_ownership,
    {_case("hosp_rating", RATINGS)} as hosp_rating,
    cast(try_cast(pred_readm_rate as float) - try_cast(exp_readm_rate as float) as double)
      as r_rate_diff
  from kept)"""

_ALL_GOLD = f"{_GOLD} select * from gold"
_SELECTED = "state in ('S1', 'S7', 'S31') and readm_type in ('AMI', 'Heart_Failure')"


def _rounded(average: str) -> str:
    # Adding zero turns the -0.0 that DuckDB's round may give into 0.0.
    return f"round({average}, 6) + 0.0"


def _mean(group: str, metric: str, where: str = "true") -> str:
    return f"""{_GOLD}
select {group}, {_rounded(f"avg(try_cast({metric} as double))")} as avg_metric
from gold where {group} is not null and {where} group by {group}"""


def _kpis(average: str, where: str = "true") -> str:
    return f"""{_GOLD}
select {average} as avg_metric, count(distinct provider_id) as hospitals,
  count(distinct state) as states
from gold where {where}"""


_VALUES = """{gold},
vals as (select try_cast({metric} as double) as v from gold where {where}),
ext as (select min(v) as lo, max(v) as hi, (max(v) - min(v)) / 20 as raw from vals)"""


def _exact(metric: str, where: str = "true") -> str:
    return f"""{_VALUES.format(gold=_GOLD, metric=metric, where=where)},
placed as (
  select cast(case when raw > 0 then least(floor((v - lo) / raw), 19) else 0 end as integer) as bin,
    lo, raw
  from vals, ext where v is not null)
select bin, lo + bin * raw as bin_start, count(*) as n from placed group by bin, lo, raw"""


def _dense(metric: str) -> str:
    return f"""{_VALUES.format(gold=_GOLD, metric=metric, where="true")},
placed as (
  select cast(case when raw > 0 then least(floor((v - lo) / raw), 19) else 0 end as integer) as bin
  from vals, ext where v is not null),
bins as (select cast(range as integer) as bin from range(20))
select bins.bin as bin, any_value(lo) + bins.bin * any_value(raw) as bin_start,
  count(placed.bin) as n
from bins left join placed on bins.bin = placed.bin, ext group by bins.bin"""


def _nice(metric: str) -> str:
    widths = " union all ".join(
        f"select {step} * pow(10.0::double, floor(log10(raw))) as w, lo, hi, raw from ext"
        for step in (1, 2, 5, 10, 20)
    )
    return f"""{_VALUES.format(gold=_GOLD, metric=metric, where="true")},
widths as ({widths}),
chosen as (
  select min(w) as w from widths where w >= raw and floor(hi / w) - floor(lo / w) < 20),
placed as (
  select floor(v / w) as place, floor(lo / w) as first, w
  from vals, ext, chosen where v is not null)
select cast(place - first as integer) as bin, place * w as bin_start, count(*) as n
from placed group by place, first, w"""


def oracle_sql() -> dict[str, str]:
    gold_count = f"{_GOLD} select count(*) as c from gold"
    facilities_declared = f"{_INPUTS} select {_typed(GEN_INFO, 'gi', as_declared=True)} from gi"
    measures_declared = f"{_INPUTS} select {_typed(READMISSIONS, 'rd', as_declared=True)} from rd"
    right_join = f"{_CHAIN} select * from joined"
    plain = {
        "json_scan_facilities": facilities_declared,
        "json_row_count": "select count(*) as c from customer",
        "csv_scan_measures": measures_declared,
        "csv_scan_inferred": measures_declared,
        "conform_rename": measures_declared,
        "conform_mixed": measures_declared,
        "json_quarantine": (
            "select '{\"provider id\": ' || c_custkey || ', \"hospital name\": \"' || c_name as line, "
            "true as has_file, (select count(*) + count(*) filter (where c_custkey % 13 = 0) "
            "from customer) as rows from customer where c_custkey % 13 = 0"
        ),
        "conform_missing_columns": (
            f"{_INPUTS} select {_typed(_PARTIAL, 'rd', as_declared=True)} from rd"
        ),
        "parquet_silver_roundtrip": (
            f"{_INPUTS} select {_typed(GEN_INFO, 'gi', as_declared=False)} from gi"
        ),
        "project_facility": (
            f'{_INPUTS} select cast(gi."provider id" as bigint) as provider_id, '
            f"{_FACILITY_LIST} from gi"
        ),
        "project_measures": (
            f'{_INPUTS} select cast(rd."Provider ID" as bigint) as provider_id, '
            f"{_MEASURE_LIST} from rd"
        ),
        "right_join_raw": right_join,
        "right_join_shuffled": right_join,
        "right_join_salted": right_join,
        "null_sentinel": f"{_CHAIN} select * from nulled",
        "require_columns": f"{_CHAIN} select * from kept",
        "recode_measure": (
            f'{_INPUTS} select {_case("""rd."Measure Name\"""", READM_TYPES)} as readm_type, '
            f"count(*) as n from rd group by 1"
        ),
        "recode_ownership": (
            f'{_INPUTS} select {_case("""gi."hospital ownership\"""", OWNERSHIPS)} '
            f"as hosp_ownership, count(*) as n from gi group by 1"
        ),
        "recode_rating": (
            f'{_INPUTS} select {_case("""gi."hospital overall rating\"""", RATINGS)} '
            f"as hosp_rating, count(*) as n from gi group by 1"
        ),
        "rate_diff": f"""{_INPUTS}
select rd."Provider ID" as provider_id, rd."Predicted Readmission Rate" as pred_readm_rate,
  rd."Expected Readmission Rate" as exp_readm_rate,
  cast(try_cast(rd."Predicted Readmission Rate" as float)
    - try_cast(rd."Expected Readmission Rate" as float) as double) as r_rate_diff
from rd""",
        "gold": _ALL_GOLD,
        "gold_shuffled": _ALL_GOLD,
        "gold_salted": _ALL_GOLD,
        "gold_count": gold_count,
        "gold_partitioned_roundtrip": _ALL_GOLD,
        "gold_partition_pruned": f"{_GOLD} select * from gold where state = 'S1'",
        "gold_repaired_count": gold_count,
        "table_checks": (
            "select 'gen_info' as table_name, count(*) as c from customer "
            "union all select 'readmissions', count(*) from orders"
        ),
        "full_run": _ALL_GOLD,
        "full_run_shuffled": _ALL_GOLD,
        "two_locations": (
            f"{_GOLD} select *, 'a' as place from gold union all "
            "select 'T' || state, * exclude (state), 'b' from gold"
        ),
        "empty_gold_keeps_old": _ALL_GOLD,
        "publish_atomic": f"{_GOLD} select *, cast(0 as integer) as torn from gold",
        "publish_dynamic_special": (
            f"{_GOLD} select case state when 'S1' then 'A B' when 'S2' then 'A/B' "
            "when 'S3' then 'A=B' when 'S4' then '50%' when 'S5' then 'O''x' when 'S6' then 'A:B' "
            "else state end as state, * exclude (state, discharges), "
            "case when state in ('S2', 'S4', 'S6') then 'again' else discharges end as discharges "
            "from gold"
        ),
        "lost_keys": (
            "select count(*) as c, "
            "count(*) filter (where c_custkey % 17 <> 0 and c_custkey % 7 <> 0) as keys, "
            "true as raised from customer"
        ),
        "default_database": "select count(*) as c from customer",
        "latest_snapshot": _ALL_GOLD,
        "latest_snapshot_parts": _ALL_GOLD,
        "latest_snapshot_rolled": _ALL_GOLD,
        "snapshot_blanks": (
            f"{_GOLD} select * replace "
            "(' ' || coalesce(discharges, 'Not Available') || ' ' as discharges) from gold"
        ),
        "snapshot_line_breaks": (
            f"{_GOLD} select * replace ('a' || chr(10) || coalesce(discharges, 'none') "
            "|| '\", \"b' as discharges) from gold"
        ),
        "snapshot_logged": (
            f"{_GOLD} select count(*) as c, cast(1 as bigint) as files, true as split from gold"
        ),
        "snapshot_dashboard_kpis": _kpis(
            _rounded("avg(try_cast(pred_readm_rate as double))"), _SELECTED
        ),
        "snapshot_files": (
            f"{_GOLD} select count(*) as c, cast(1 as bigint) as files from gold"
        ),
        "snapshot_provenance": (
            f"{_GOLD} select count(*) as c, true as is_newest, true as is_utc from gold"
        ),
        "kpi_summary": _kpis(_rounded("avg(r_rate_diff)")),
        "kpi_summary_filtered": _kpis(
            _rounded("avg(try_cast(discharges as double))"), _SELECTED
        ),
        "kpi_labels": _kpis("printf('%.2f', avg(r_rate_diff))"),
        "kpi_labels_empty": _kpis(
            "coalesce(printf('%.2f', avg(r_rate_diff)), 'N/A')", "state = ''"
        ),
        "mean_by_ownership": _mean("hosp_ownership", "r_rate_diff"),
        "mean_by_rating": _mean("hosp_rating", "r_rate_diff"),
        "mean_by_rating_text_metric": _mean("hosp_rating", "readmissions"),
        "mean_by_state": _mean("state", "r_rate_diff"),
        "histogram_exact": _exact("r_rate_diff"),
        "histogram_exact_text_metric": _exact("discharges"),
        "histogram_dense": _dense("r_rate_diff"),
        "histogram_nice": _nice("r_rate_diff"),
        "histogram_nice_text_metric": _nice("excess_readm_ratio"),
        "filter_state_type": f"{_GOLD} select * from gold where {_SELECTED}",
        "filter_none": _ALL_GOLD,
        "states_list": f"{_GOLD} select distinct state from gold where state is not null",
        "types_list": f"{_GOLD} select distinct readm_type from gold where readm_type is not null",
        "dashboard_kpis": _kpis(_rounded("avg(try_cast(pred_readm_rate as double))"), _SELECTED),
        "dashboard_kpi_labels": _kpis(
            "printf('%.2f', avg(try_cast(pred_readm_rate as double)))", _SELECTED
        ),
        "dashboard_mean_by_group": _mean("hosp_rating", "pred_readm_rate", _SELECTED),
        "dashboard_mean_by_state": _mean("state", "pred_readm_rate", _SELECTED),
        "dashboard_histogram": _exact("pred_readm_rate", _SELECTED),
        "dashboard_rows": f"{_GOLD} select * from gold where {_SELECTED}",
        "preview_10": (
            f"{_ALL_GOLD} order by {', '.join(f'{snake(c)} nulls first' for c in GOLD.names)} "
            f"limit 10"
        ),
    }
    return plain | {summary: plain[query] for summary, query in _SUMMARISED.items()}


#: Queries over the stored summary, and those over Gold that they must equal.
_SUMMARISED = {
    "full_run_summary": "kpi_summary",
    "summary_kpis": "kpi_summary",
    "summary_kpis_filtered": "kpi_summary_filtered",
    "summary_kpis_empty": "kpi_labels_empty",
    "summary_kpi_labels": "kpi_labels",
    "summary_mean_by_ownership": "mean_by_ownership",
    "summary_mean_by_rating": "mean_by_rating_text_metric",
    "summary_mean_by_state": "mean_by_state",
    "summary_selected_kpis": "dashboard_kpis",
    "summary_selected_mean_by_group": "dashboard_mean_by_group",
    "summary_selected_mean_by_state": "dashboard_mean_by_state",
    "summary_states": "states_list",
    "summary_types": "types_list",
}
