from __future__ import annotations

import json
import os
import uuid

import pytest

from frames import gold_rows, rows
from medallion import Paths, catalog, publish_gold, run
from medallion.errors import (
    EmptyInput,
    EmptyResult,
    LocationMismatch,
    LostKeys,
    MissingColumns,
    UnknownOption,
)
from medallion.plans.pipeline import read_published
from medallion.plans.silver import build_readmissions
from medallion.schemas import READMISSIONS
from medallion.sinks import write_gold
from medallion.sources import read_gold, read_latest_snapshot
from medallion_checks.queries import counted_by_a_reader


@pytest.fixture
def database():
    return f"db_{uuid.uuid4().hex}"


@pytest.fixture
def paths(tmp_path):
    return Paths.under(str(tmp_path))


def published(spark, database):
    return read_published(spark, f"`{database}`.gold_merged")


def write_raw(paths, facilities, measures, header=READMISSIONS.names):
    os.makedirs(paths.gen_info_raw)
    os.makedirs(paths.readmissions_raw)
    with open(f"{paths.gen_info_raw}/a.json", "w") as f:
        f.writelines(json.dumps(row) + "\n" for row in facilities)
    with open(f"{paths.readmissions_raw}/a.csv", "w") as f:
        f.write(",".join(header) + "\n")
        f.writelines(",".join(row.get(c, "") for c in header) + "\n" for row in measures)


def raw_facility(key):
    return {
        "provider id": key,
        "hospital ownership": "Tribal",
        "hospital overall rating": "5",
    }


def raw_measure(key, state, pred="16.1"):
    return {
        "Provider ID": str(key),
        "State": state,
        "Measure Name": "READM_30_AMI_HRRP",
        "Number of Discharges": "12",
        "Predicted Readmission Rate": pred,
        "Expected Readmission Rate": "15.7",
    }


def test_full_run(spark, paths, database, capsys):
    write_raw(
        paths,
        [raw_facility(1), raw_facility(2), raw_facility(3)],
        [
            raw_measure(1, "AK"),
            raw_measure(2, "TX"),
            raw_measure(2, "TX", "Not Available"),
            raw_measure(9, "TX"),
        ],
    )
    report = run(spark, paths, database=database)
    assert report.rows == {
        "gen_info": 3,
        "readmissions": 4,
        f"`{database}`.`gen_info`": 3,
        f"`{database}`.`readmissions`": 4,
        "gold": 2,
    }
    assert "provider_id" in capsys.readouterr().out
    expected = [
        ("AK", 1, "AMI", "12", None, None, "16.1", "15.7", "Tribal", "5 Star", 0.40000057220458984),
        ("TX", 2, "AMI", "12", None, None, "16.1", "15.7", "Tribal", "5 Star", 0.40000057220458984),
    ]
    assert rows(published(spark, database)) == expected
    assert rows(read_latest_snapshot(spark, paths.snapshot)) == expected
    table = catalog.read_table(spark, f"`{database}`.gold_merged")
    assert table.columns[-1] == "state" and table.count() == 2


def test_run_with_a_shuffled_join_gives_the_same(spark, paths, database):
    write_raw(
        paths,
        [raw_facility(1), raw_facility(2)],
        [raw_measure(1, "AK"), raw_measure(2, "TX"), raw_measure(2, "TX", "Not Available")],
    )
    run(spark, paths, database=database, show=False)
    expected = rows(published(spark, database))
    run(spark, paths, "gold", database=database, show=False, broadcast_limit=0)
    assert rows(published(spark, database)) == expected
    assert len(expected) == 2


def test_gold_keeps_the_last_version_only(spark, paths, database):
    catalog.create_tables(spark, paths, database)
    for state in ("AK", "TX", "WA"):
        publish_gold(gold_rows(spark, {"state": state}), paths, f"`{database}`.gold_merged")
    assert [r["state"] for r in published(spark, database).collect()] == ["WA"]
    assert len(os.listdir(paths.gold)) == 2


def test_a_table_elsewhere_raises_or_moves(spark, tmp_path, database):
    a, b = Paths.under(str(tmp_path / "a")), Paths.under(str(tmp_path / "b"))
    write_raw(a, [raw_facility(1)], [raw_measure(1, "AK")])
    write_raw(b, [raw_facility(1), raw_facility(2)], [raw_measure(2, "TX")])
    run(spark, a, database=database, show=False)
    old = read_gold(spark, catalog.table_location(spark, f"`{database}`.gold_merged"))
    with pytest.raises(LocationMismatch):
        run(spark, b, database=database, show=False)
    run(spark, b, database=database, show=False, move_tables=True)
    assert [r["state"] for r in published(spark, database).collect()] == ["TX"]
    assert [r["state"] for r in old.collect()] == ["AK"]


def test_keys_that_do_not_fit_raise_when_strict(spark, paths, database):
    write_raw(paths, [raw_facility(1), raw_facility(1 << 33)], [raw_measure(1, "AK")])
    with pytest.raises(LostKeys):
        run(spark, paths, database=database, show=False)
    run(spark, paths, database=database, show=False, strict=False)
    with open(f"{paths.readmissions_raw}/b.csv", "w") as f:
        f.write(",".join(READMISSIONS.names) + "\n")
        f.write(",".join(raw_measure(1 << 40, "TX").get(c, "") for c in READMISSIONS.names) + "\n")
    with pytest.raises(LostKeys):
        build_readmissions(spark, paths.readmissions_raw, paths.readmissions)


def test_stages_run_apart(spark, paths, database):
    write_raw(paths, [raw_facility(1)], [raw_measure(1, "AK")])
    assert run(spark, paths, "silver", database=database).rows == {
        "gen_info": 1,
        "readmissions": 1,
    }
    assert not os.path.exists(paths.gold)
    checks = run(spark, paths, "checks", database=database).rows
    assert sorted(checks.values()) == [1, 1]
    assert run(spark, paths, "gold", database=database, show=False).rows == {"gold": 1}
    with pytest.raises(UnknownOption):
        run(spark, paths, "app", database=database)


def test_checks_fail_on_tables_nobody_made(spark, paths, database):
    with pytest.raises(Exception, match="NOT_FOUND"):
        run(spark, paths, "checks", database=database)


def test_second_full_run_in_the_same_session_sees_the_new_data(spark, paths, database):
    write_raw(paths, [raw_facility(1)], [raw_measure(1, "AK")])
    run(spark, paths, database=database, show=False)
    with open(f"{paths.gen_info_raw}/b.json", "w") as f:
        f.write(json.dumps(raw_facility(2)) + "\n")
    with open(f"{paths.readmissions_raw}/b.csv", "w") as f:
        f.write(",".join(READMISSIONS.names) + "\n")
        f.write(",".join(raw_measure(2, "TX").get(c, "") for c in READMISSIONS.names) + "\n")
    report = run(spark, paths, database=database, show=False)
    assert set(report.rows.values()) == {2}
    assert catalog.count_rows(spark, f"`{database}`.gold_merged").first()["c"] == 2


def test_second_run_forgets_states_that_are_gone(spark, paths, database):
    gold_table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    first = gold_rows(spark, {"state": "AK"}, {"state": "TX"})
    assert publish_gold(first, paths, gold_table, show=False) == 2
    second = gold_rows(spark, {"state": "TX"})
    assert publish_gold(second, paths, gold_table, show=False) == 1
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {gold_table}").collect()] == ["state=TX"]
    assert catalog.read_table(spark, gold_table).count() == 1


def test_dynamic_publication_keeps_other_states_everywhere(spark, paths, database):
    gold_table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    publish_gold(gold_rows(spark, {"state": "AK"}), paths, gold_table, show=False)
    added = gold_rows(spark, {"state": "TX"})
    assert publish_gold(added, paths, gold_table, dynamic=True, show=False) == 2
    for df in (
        catalog.read_table(spark, gold_table),
        read_latest_snapshot(spark, paths.snapshot),
    ):
        assert sorted(r["state"] for r in df.collect()) == ["AK", "TX"]


def test_empty_gold_raises_and_leaves_the_old_output(spark, paths, database):
    gold_table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    old = gold_rows(spark, {"state": "AK"})
    publish_gold(old, paths, gold_table, show=False)
    with pytest.raises(EmptyResult):
        publish_gold(old.filter("false"), paths, gold_table, show=False)
    assert rows(published(spark, database)) == rows(old)
    assert rows(read_latest_snapshot(spark, paths.snapshot)) == rows(old)


def test_empty_facilities_stop_the_run(spark, paths, database):
    write_raw(paths, [], [raw_measure(1, "AK")])
    with pytest.raises(EmptyInput):
        run(spark, paths, database=database)
    assert not os.path.exists(paths.gen_info)


def test_missing_state_stops_the_run_unless_allowed(spark, paths, database):
    header = [c for c in READMISSIONS.names if c != "State"]
    write_raw(paths, [raw_facility(1)], [raw_measure(1, "AK")], header)
    with pytest.raises(MissingColumns):
        run(spark, paths, database=database)
    with pytest.warns(UserWarning), pytest.raises(EmptyResult):
        run(spark, paths, database=database, strict=False)


SPECIAL = ["A B", "A/B", "A=B", "50%", "O'x", "A:B", "Ü b", "a\\b", 'q"x', "null"]


@pytest.mark.parametrize("state", SPECIAL)
def test_dynamic_publication_of_a_special_state(spark, paths, database, state):
    table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    publish_gold(gold_rows(spark, {"state": state}, {"state": "AK"}), paths, table, show=False)
    again = gold_rows(spark, {"state": state, "Discharges": "9"})
    assert publish_gold(again, paths, table, dynamic=True, show=False) == 2
    got = {r["state"]: r["Discharges"] for r in published(spark, database).collect()}
    assert got == {state: "9", "AK": None}
    assert publish_gold(again, paths, table, show=False) == 1


def test_dynamic_publications_keep_the_versions_they_read(spark, paths, database):
    table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    publish_gold(gold_rows(spark, *({"state": s} for s in "abc")), paths, table, show=False)
    for n, state in enumerate("abcabc"):
        again = gold_rows(spark, {"state": state, "provider_id": n})
        assert publish_gold(again, paths, table, dynamic=True, show=False) == 3
    got = {r["state"]: r["provider_id"] for r in published(spark, database).collect()}
    assert got == {"a": 3, "b": 4, "c": 5}
    assert len(os.listdir(paths.gold)) == 4


def test_a_reader_sees_whole_versions_only(spark, paths, database):
    table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    sizes = [6, 9, 2, 7]
    for k, size in enumerate(sizes):
        rows_of = [{"state": f"{k % 2}{n}"} for n in range(size)]
        if not k:
            publish_gold(gold_rows(spark, *rows_of), paths, table, show=False)
            continue
        with counted_by_a_reader(spark, table) as seen:
            publish_gold(gold_rows(spark, *rows_of), paths, table, show=False)
        assert set(seen) <= {sizes[k - 1], size}


def test_a_publication_that_broke_off_is_completed(spark, paths, database, monkeypatch):
    table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    publish_gold(gold_rows(spark, {"state": "AK"}), paths, table, show=False)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(catalog, "_switch_partitions", broken)
        publish_gold(gold_rows(spark, {"state": "TX"}), paths, table, show=False)
    assert [r["state"] for r in published(spark, database).collect()] == ["AK"]
    catalog.complete_publication(spark, table)
    assert [r["state"] for r in published(spark, database).collect()] == ["TX"]
    publish_gold(gold_rows(spark, {"state": "WA"}), paths, table, dynamic=True, show=False)
    assert sorted(r["state"] for r in published(spark, database).collect()) == ["TX", "WA"]


def test_statements_do_not_grow_with_partitions(spark, paths, database, monkeypatch):
    table = f"`{database}`.gold_merged"
    catalog.create_tables(spark, paths, database)
    folder = f"{paths.gold}/version-x"
    write_gold(gold_rows(spark, {"state": "AK"}), folder)
    place = catalog.partition_folders(spark, folder)["AK"]
    counts = []
    for n in (5, 300):
        catalog.write_manifest(spark, folder, {f"S{n} {k}": place for k in range(n)})
        statements = []
        plain = type(spark).sql
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", lambda s, q, *a, **b: (statements.append(q), plain(s, q, *a, **b))[1])
            catalog.show_manifest(spark, table, folder)
        counts.append(len(statements))
        assert catalog.count_rows(spark, table).first()["c"] == n
    # The second one drops the partitions of the first.
    assert counts[1] <= counts[0] + 1


def test_preview_of_a_run(spark, paths, database, capsys):
    write_raw(paths, [raw_facility(1)], [raw_measure(1, "AK")])
    run(spark, paths, database=database, show=True)
    out = capsys.readouterr().out
    assert "|AK   |1          |AMI" in out and "only showing" not in out


# --- catalog ---


def test_partitions_are_seen_after_repair(spark, paths, database):
    catalog.create_tables(spark, paths, database)
    write_gold(gold_rows(spark, {"state": "AK"}, {"state": "01"}), paths.gold)
    table = f"`{database}`.gold_merged"
    assert catalog.check_tables(spark, [table]) == {table: 0}
    catalog.repair_partitions(spark, table)
    assert catalog.check_tables(spark, [table]) == {table: 2}
    assert {r["state"] for r in catalog.read_table(spark, table).collect()} == {"AK", "01"}


def test_declared_tables(spark, paths, database):
    catalog.create_tables(spark, paths, database)
    catalog.create_tables(spark, paths, database)
    assert len(spark.table(f"`{database}`.gen_info").columns) == 29
    assert len(spark.table(f"`{database}`.readmissions").columns) == 12
    gold = spark.table(f"`{database}`.gold_merged")
    assert gold.columns[-1] == "state"
    assert dict(gold.dtypes)["R Rate Diff"] == "double"
    # Names resolve whatever their case, as both key spellings rely on.
    assert spark.table(f"`{database}`.readmissions").select("`provider id`").columns


def test_default_database(spark, paths, database):
    catalog.create_tables(spark, paths, database)
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    try:
        assert catalog.count_rows(spark, "gen_info").first()["c"] == 0
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_unreadable_table_raises(spark, paths, database):
    catalog.create_tables(spark, paths, database)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.check_tables(spark, [f"`{database}`.absent"])


def test_location_with_a_quote(spark, tmp_path, database):
    paths = Paths.under(str(tmp_path / "it's"))
    catalog.create_tables(spark, paths, database)
    write_gold(gold_rows(spark, {"state": "AK"}), paths.gold)
    table = f"`{database}`.gold_merged"
    catalog.repair_partitions(spark, table)
    assert catalog.check_tables(spark, [table]) == {table: 1}


def test_session_builder_reuses_the_running_session(spark):
    assert catalog.build_session("again") is not None
    assert spark.range(1).count() == 1
