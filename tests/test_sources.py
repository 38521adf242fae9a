from __future__ import annotations

import os

import pytest

from frames import gold_rows, physical_plan_of, rows
from medallion.errors import EmptyInput, HeaderMismatch, MissingColumns
from medallion.operators.conform import check_columns, rename_alternates, require_rows
from medallion import sinks
from medallion.locations import join_files, write_text
from medallion.plans.silver import build_gen_info
from medallion.schemas import ALTERNATE_HEADERS, GEN_INFO, GOLD, READMISSIONS
from medallion.sinks import write_snapshot
from medallion.sources import (
    latest_csv,
    load_latest_snapshot,
    read_gen_info_json,
    read_gold,
    read_latest_snapshot,
    read_measures_csv,
    snapshot_provenance,
)
from medallion.sources.snapshot import utc_label


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def csv_line(header, **values):
    return ",".join(values.get(c.replace(" ", "_"), "") for c in header)


# --- JSON ---


def test_json_wrong_types_and_bad_lines(spark, tmp_path):
    write(
        tmp_path / "in" / "a.json",
        '{"provider id": 5, "hospital name": "A", "emergency services": true}\n'
        '{"provider id": "010002", "emergency services": "Yes"}\n'
        '{"provider id": 99999999999, "phone number": 99999999999}\n'
        "{broken\n"
        "\n"
        '[{"provider id": 7}, {"provider id": 8}]\n'
        '{"provider id": 9, "location": {"lat":1}}\n'
        '{"Provider ID": 10, "extra": 1}\n',
    )
    df = read_gen_info_json(spark, str(tmp_path / "in"))
    assert df.schema == GEN_INFO
    got = [
        (r["provider id"], r["emergency services"], r["phone number"], r["location"])
        for r in df.collect()
    ]
    assert got == [
        (5, True, None, None),
        (None, None, None, None),
        (None, None, 99999999999, None),
        (None, None, None, None),
        (7, None, None, None),
        (8, None, None, None),
        (9, None, None, '{"lat":1}'),
        (None, None, None, None),
    ]
    assert df.count() == 8


def test_empty_source_raises(spark, tmp_path):
    write(tmp_path / "in" / "a.json", "\n")
    with pytest.raises(EmptyInput, match="a place"):
        require_rows(read_gen_info_json(spark, str(tmp_path / "in")), "a place")


# --- CSV ---


def test_csv_types_nulls_and_quotes(spark, tmp_path):
    header = READMISSIONS.names
    line = csv_line(
        header,
        Hospital_Name='"A, ""B"""'.replace('""', '\\"'),
        Provider_ID="010001",
        State="AL",
        Number_of_Discharges="12",
        Footnote='""',
        Start_Date="07/01/2013",
    )
    write(tmp_path / "in" / "a.csv", ",".join(header) + "\n" + line + "\n")
    df = read_measures_csv(spark, str(tmp_path / "in"))
    assert df.schema == READMISSIONS
    row = df.first()
    assert row["Hospital Name"] == 'A, "B"'
    assert row["Provider ID"] == 10001
    assert row["Number of Discharges"] == "12"
    assert row["Start Date"] == "07/01/2013"
    assert row["Footnote"] is None and row["End Date"] is None


def test_csv_inferred_types(spark, tmp_path):
    header = READMISSIONS.names
    line = csv_line(header, Provider_ID="010001", Number_of_Discharges="12", State="AL")
    write(tmp_path / "in" / "a.csv", ",".join(header) + "\n" + line + "\n")
    df = read_measures_csv(spark, str(tmp_path / "in"), infer=True)
    assert dict(df.dtypes)["Number of Discharges"] == "int"
    assert df.first()["Provider ID"] == 10001


def test_csv_alternate_header(spark, tmp_path):
    old = {new: alternate for alternate, new in ALTERNATE_HEADERS.items()}
    header = [old.get(c, c) for c in READMISSIONS.names]
    line = csv_line(READMISSIONS.names, Provider_ID="7", State="AL", Measure_Name="M")
    write(tmp_path / "in" / "a.csv", ",".join(header) + "\n" + line + "\n")
    df = read_measures_csv(spark, str(tmp_path / "in"))
    assert df.schema == READMISSIONS
    assert (df.first()["Provider ID"], df.first()["Measure Name"]) == (7, "M")


def test_csv_reordered_header_in_a_second_file_fails(spark, tmp_path):
    header = READMISSIONS.names
    line = csv_line(header, Provider_ID="1", State="AL")
    write(tmp_path / "in" / "a.csv", ",".join(header) + "\n" + line + "\n")
    other = header[::-1]
    line = csv_line(other, Provider_ID="2", State="AK")
    write(tmp_path / "in" / "b.csv", ",".join(other) + "\n" + line + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        read_measures_csv(spark, str(tmp_path / "in")).collect()


def mixed_folder(tmp_path, *headers):
    for n, header in enumerate(headers):
        canonical = [ALTERNATE_HEADERS.get(c, c) for c in header]
        line = csv_line(canonical, Provider_ID=str(n), State="AL", Hospital_Name='"A, B"')
        write(tmp_path / "in" / f"{n}.csv", ",".join(header) + "\n" + line + "\n" + line + "\n")
    return str(tmp_path / "in")


def test_csv_with_canonical_and_alternate_headers(spark, tmp_path):
    old = {new: alternate for alternate, new in ALTERNATE_HEADERS.items()}
    names = READMISSIONS.names
    half = [old.get(c, c) if k % 2 else c for k, c in enumerate(names)]
    folder = mixed_folder(tmp_path, names, [old.get(c, c) for c in names], half, names)
    df = read_measures_csv(spark, folder, mixed=True)
    assert df.schema == READMISSIONS
    got = sorted((r["Provider ID"], r["State"], r["Hospital Name"]) for r in df.collect())
    assert got == [(n, "AL", "A, B") for n in range(4) for _ in range(2)]


@pytest.mark.parametrize("change", [lambda h: h[::-1], lambda h: h[1:], lambda h: [*h, "more"]])
def test_csv_headers_that_differ_otherwise_fail(spark, tmp_path, change):
    folder = mixed_folder(tmp_path, READMISSIONS.names, change(READMISSIONS.names))
    with pytest.raises(HeaderMismatch, match="header"):
        read_measures_csv(spark, folder, mixed=True)


def test_malformed_lines_have_their_own_table(spark, tmp_path):
    lines = ['{"provider id": 5}', "{broken", "", '{"provider id": "x", "city": "B"}', "[{\"provider id\": 7}]", "plain"]
    write(tmp_path / "in" / "a.json", "\n".join(lines) + "\n")
    folder = str(tmp_path / "in")
    rows_of = build_gen_info(spark, folder, str(tmp_path / "silver"), quarantine=str(tmp_path / "bad"))
    assert rows_of == read_gen_info_json(spark, folder).count() == 5
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r["line"], r["city"]) for r in bad) == sorted([(lines[1], None), (lines[3], "B"), (lines[5], None)])
    assert all(r["file"].endswith("/in/a.json") for r in bad)


def test_csv_missing_columns(spark, tmp_path):
    header = [c for c in READMISSIONS.names if c not in ("State", "Footnote")]
    write(tmp_path / "in" / "a.csv", ",".join(header) + "\n" + csv_line(header) + "\n")
    with pytest.raises(MissingColumns) as error:
        read_measures_csv(spark, str(tmp_path / "in"))
    assert error.value.columns == ["State"]
    with pytest.warns(UserWarning, match="State, Footnote"):
        df = read_measures_csv(spark, str(tmp_path / "in"), strict=False)
    assert df.columns == header


def test_rename_guards(spark):
    both = spark.createDataFrame([(1, 2)], "`provider_id#1` int, `Provider ID` int")
    assert rename_alternates(both, ALTERNATE_HEADERS).columns == both.columns
    upper = spark.createDataFrame([(1,)], "`PROVIDER_ID#1` int")
    assert rename_alternates(upper, ALTERNATE_HEADERS).columns == upper.columns


def test_check_columns_lists_what_is_absent(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.warns(UserWarning):
        assert check_columns(df, ["a", "b"], []) == ["b"]


# --- Gold by path, snapshots ---


def test_digit_partition_values_stay_text(spark, tmp_path):
    df = gold_rows(spark, {"state": "01", "provider_id": 1})
    df.write.partitionBy("state").parquet(str(tmp_path / "gold"))
    got = read_gold(spark, str(tmp_path / "gold"))
    assert got.columns == GOLD.names
    assert got.first()["state"] == "01"


def snapshot(spark, path, *items, **options):
    df = gold_rows(spark, *items)
    write_snapshot(df, str(path), **options)
    return df


def age(folder, seconds):
    for root, _, names in os.walk(folder):
        for name in names:
            os.utime(os.path.join(root, name), (seconds, seconds))


def test_newest_non_empty_csv_is_chosen(spark, tmp_path):
    snapshot(spark, tmp_path / "a b" / "one", {"state": "AK"})
    new = snapshot(spark, tmp_path / "a b" / "t[w]o", {"state": "TX", "R Rate Diff": 0.5}, {})
    write(tmp_path / "a b" / "empty.csv", "")
    write(tmp_path / "a b" / "note.txt", "x")
    age(tmp_path / "a b" / "one", 1_000_000_000)
    age(tmp_path / "a b" / "t[w]o", 1_000_000_060)
    folder = str(tmp_path / "a b")
    found = latest_csv(spark, folder).first()
    assert "t[w]o/part-" in found["path"]
    assert snapshot_provenance(spark, folder).first()["last_updated"] == "2001-09-09 01:47 UTC"
    assert rows(read_latest_snapshot(spark, folder)) == rows(new)


def test_equally_new_files_are_decided_by_path(spark, tmp_path):
    for name in ("b.csv", "a.csv"):
        write(tmp_path / "s" / name, ",".join(GOLD.names) + "\n")
    age(tmp_path / "s", 1_000_000_000)
    assert latest_csv(spark, str(tmp_path / "s")).first()["path"].endswith("/b.csv")


def test_all_parts_of_the_newest_snapshot_are_read(spark, tmp_path):
    items = [{"provider_id": n, "state": f"S{n % 5}"} for n in range(50)]
    df = gold_rows(spark, *items).repartition(5)
    write_snapshot(df, str(tmp_path / "s" / "new"), single_file=False)
    parts = [n for n in os.listdir(tmp_path / "s" / "new") if n.endswith(".csv")]
    assert len(parts) == 5
    # A stray file of another write in the same folder is not part of the snapshot.
    write(tmp_path / "s" / "new" / "stray.csv", ",".join(GOLD.names) + "\nXX" + "," * 10 + "\n")
    age(tmp_path / "s", 1_000_000_000)
    os.utime(tmp_path / "s" / "new" / parts[2], (1_000_000_050, 1_000_000_050))
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s"))) == rows(df)


@pytest.mark.parametrize("tasks", [1, 2])
def test_all_files_of_a_task_are_read(spark, tmp_path, conf, tasks):
    conf("spark.sql.files.maxRecordsPerFile", "7")
    df = gold_rows(spark, *({"provider_id": n} for n in range(30))).repartition(tasks)
    write_snapshot(df, str(tmp_path / "s"), single_file=False)
    snapshot = load_latest_snapshot(spark, str(tmp_path / "s"))
    assert rows(snapshot.rows) == rows(df)
    assert "/part-" in snapshot.path and snapshot.last_updated.endswith(" UTC")


def test_snapshot_keeps_blanks(spark, tmp_path):
    texts = [" lead", "trail ", "Not Available ", "  both  "]
    df = snapshot(spark, tmp_path / "s", *({"Hosp Ownership": t} for t in texts))
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s"))) == rows(df)


def test_snapshot_keeps_line_breaks_quotes_and_commas(spark, tmp_path):
    texts = ["two\nlines", 'a "quoted" word', "a, b", "back\\slash", 'mixed ", \n "x"']
    df = snapshot(spark, tmp_path / "s", *({"Hosp Ownership": t} for t in texts))
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s"))) == rows(df)


@pytest.mark.parametrize("broken", [False, True])
def test_one_file_is_split_where_no_value_holds_a_line_break(spark, tmp_path, conf, broken):
    items = [{"provider_id": n, "state": f"S{n}", "Hosp Rating": "x" * 50} for n in range(400)]
    if broken:
        items[7]["Hosp Rating"] = "two\r\nlines"
    df = snapshot(spark, tmp_path / "s" / "new", *items)
    conf("spark.sql.files.maxPartitionBytes", "2k")
    conf("spark.sql.files.openCostInBytes", "1")
    got = read_latest_snapshot(spark, str(tmp_path / "s"))
    assert (got.rdd.getNumPartitions() > 3) is not broken
    if not broken:
        assert rows(got) == rows(df)
    else:
        assert got.count() == 400


def test_the_log_names_the_newest_snapshot_without_a_listing(spark, tmp_path):
    folder = tmp_path / "s"
    old = gold_rows(spark, {"state": "AK"})
    new = gold_rows(spark, {"state": "TX"}, {"state": "WA"})
    write_snapshot(old, str(folder / "1"), log=str(folder))
    write_snapshot(new, str(folder / "2"), log=str(folder), single_file=False)
    assert rows(read_latest_snapshot(spark, str(folder))) == rows(new)
    plan = latest_csv(spark, str(folder))._jdf.queryExecution().analyzed().toString()
    assert "binaryFile" in plan
    # What the log does not name is not looked at.
    write(folder / "0" / "stray.csv", ",".join(GOLD.names) + "\n")
    assert "/2/part-" in latest_csv(spark, str(folder)).first()["path"]
    # A record that no longer fits its file gives way to the listing.
    age(folder / "2", 1_000_000_000)
    assert latest_csv(spark, str(folder)).first()["path"].endswith("/0/stray.csv")
    write_text(spark, str(folder / "_snapshot.json"), "{broken")
    assert latest_csv(spark, str(folder)).first()["path"].endswith("/0/stray.csv")


def test_parts_are_joined_behind_one_header(spark, tmp_path):
    df = gold_rows(spark, *({"provider_id": n, "state": f"S{n}"} for n in range(200))).repartition(7)
    write_snapshot(df, str(tmp_path / "s"))
    assert sorted(os.listdir(tmp_path)) == ["s"]
    (name,) = [n for n in os.listdir(tmp_path / "s") if n.endswith(".csv") and not n.startswith(".")]
    lines = (tmp_path / "s" / name).read_text().splitlines()
    assert lines.count(",".join(GOLD.names)) == 1 and len(lines) == 201
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s"))) == rows(df)
    write_snapshot(df.filter("false"), str(tmp_path / "s"))
    assert read_latest_snapshot(spark, str(tmp_path / "s")).isEmpty()


def test_no_snapshot_gives_no_rows(spark, tmp_path):
    os.makedirs(tmp_path / "s")
    assert latest_csv(spark, str(tmp_path / "s")).collect() == [(None, None)]
    empty = read_latest_snapshot(spark, str(tmp_path / "s"))
    assert empty.schema == GOLD and empty.isEmpty()


def test_utc_label_in_another_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    df = spark.sql("select timestamp_seconds(1756303500) as t")
    assert df.select(utc_label(df.t)).first()[0] == "2025-08-27 14:05 UTC"


def test_files_of_a_snapshot_are_listed_by_their_folder(spark, tmp_path, conf):
    conf("spark.sql.files.maxRecordsPerFile", "2")
    df = gold_rows(spark, *({"provider_id": n} for n in range(90))).repartition(2)
    write_snapshot(df, str(tmp_path / "s{1}" / "new"), single_file=False)
    conf("spark.sql.sources.parallelPartitionDiscovery.threshold", "32")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    try:
        got = read_latest_snapshot(spark, str(tmp_path / "s{1}" / "new"))
        # One job finds the newest file; none looks the 45 and more files up one by one.
        assert len(tracker.getJobIdsForGroup("listing")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(got) == rows(df)
    # A copy of the files in a folder of its own below the snapshot's is no part of it.
    write(tmp_path / "s{1}" / "new" / "kept" / "other.csv", "x\n")
    for file in list((tmp_path / "s{1}" / "new").glob("part-*.csv"))[:3]:
        (tmp_path / "s{1}" / "new" / "kept" / file.name).write_bytes(file.read_bytes())
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s{1}" / "new"))) == rows(df)


def test_joined_parts_ignore_the_limit_of_records(spark, tmp_path, conf, monkeypatch):
    conf("spark.sql.files.maxRecordsPerFile", "2")
    joined = []
    monkeypatch.setattr(sinks, "join_files", lambda spark, sources, target: joined.append(sources) or join_files(spark, sources, target))
    df = gold_rows(spark, *({"provider_id": n} for n in range(60))).repartition(3)
    write_snapshot(df, str(tmp_path / "s"))
    assert len(joined[0]) == 4
    assert rows(read_latest_snapshot(spark, str(tmp_path / "s"))) == rows(df)


@pytest.mark.parametrize("single_file", [True, False])
@pytest.mark.parametrize("size", ["300", "3k"])
def test_a_large_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, conf, single_file, size):
    texts = [
        "two\nlines", "a\r\nb\rc", 'one "\n" quote', 'end"', "\\", 'x\\"\n\\', "\n\n\n", ", \n, ", '"', "plain", " a ", None,
        "back\\slash", "é\n漢字 x", "a\\\nb", "x" * 500 + "\n" + 'y"' * 300,
    ]
    items = [
        {"provider_id": n, "state": texts[(n * 7 + 3) % 16], "Hosp Rating": texts[n % 16], "R Rate Diff": n / 8}
        for n in range(80)
    ]
    df = gold_rows(spark, *items).repartition(3)
    write_snapshot(df, str(tmp_path / "s"), single_file=single_file)
    whole = rows(read_latest_snapshot(spark, str(tmp_path / "s")))
    conf("spark.sql.files.maxPartitionBytes", size)
    conf("spark.sql.files.openCostInBytes", "1")
    got = read_latest_snapshot(spark, str(tmp_path / "s"))
    assert got.schema == GOLD and rows(got) == whole
    assert len(whole) == 80
    assert "FileScan text" in physical_plan_of(got)
