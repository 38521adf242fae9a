from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from frames import gold_rows, rows
from medallion.locations import Paths, discard, scratch_folder
from medallion.schemas import GOLD
from medallion.sinks import preview, write_gold, write_silver, write_snapshot
from medallion.sources import read_gold


def states_on_disk(path):
    return sorted(n for n in os.listdir(path) if n.startswith("state="))


def data_files(path, ending):
    return [n for n in os.listdir(path) if n.endswith(ending)]


def test_silver_round_trip_replaces_the_dataset(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark.range(10), path)
    write_silver(spark.range(3), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]


def test_gold_round_trip(spark, tmp_path):
    df = gold_rows(spark, {"state": "AK"}, {"state": "TX", "R Rate Diff": 0.40000057220458984})
    write_gold(df, str(tmp_path / "gold"))
    assert states_on_disk(tmp_path / "gold") == ["state=AK", "state=TX"]
    assert spark.read.parquet(str(tmp_path / "gold")).columns[-1] == "state"
    assert rows(read_gold(spark, str(tmp_path / "gold"))) == rows(df)


def test_states_with_odd_names(spark, tmp_path):
    names = ["A/B", "x=y", "N:M", "100%", "Ü b", "01", "null", "None", "2024-01-01"]
    df = gold_rows(spark, *({"state": name} for name in names))
    write_gold(df, str(tmp_path / "gold"))
    assert rows(read_gold(spark, str(tmp_path / "gold"))) == rows(df)


@pytest.mark.parametrize(("dynamic", "left"), [(False, ["TX"]), (True, ["AK", "TX"])])
def test_overwrite_of_all_or_of_the_written_states(spark, tmp_path, dynamic, left):
    path = str(tmp_path / "gold")
    write_gold(gold_rows(spark, {"state": "AK"}, {"state": "TX"}), path)
    write_gold(gold_rows(spark, {"state": "TX", "Discharges": "9"}), path, dynamic=dynamic)
    assert states_on_disk(path) == [f"state={s}" for s in left]
    got = read_gold(spark, path)
    assert [r["Discharges"] for r in got.filter("state = 'TX'").collect()] == ["9"]


def skewed(spark):
    """Twelve input partitions; a third of the rows in one state."""
    base = spark.range(0, 60_000, 1, 12)
    state = F.when(F.col("id") % 3 == 0, "HOT").otherwise(
        F.concat(F.lit("S"), (F.col("id") % 7).cast("string"))
    )
    text = F.sha2(F.col("id").cast("string"), 256)
    return base.select(
        *(
            state.alias("state")
            if f.name == "state"
            else F.col("id").alias(f.name)
            if f.name == "provider_id"
            else F.lit(0.0).alias(f.name)
            if f.name == "R Rate Diff"
            else text.alias(f.name)
            for f in GOLD
        )
    )


def test_a_hot_state_is_split_and_small_states_are_not(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    df = skewed(spark)
    write_gold(df, str(tmp_path / "gold"))
    files = {
        s: len(data_files(tmp_path / "gold" / s, ".parquet"))
        for s in states_on_disk(tmp_path / "gold")
    }
    assert files.pop("state=HOT") >= 3
    assert max(files.values()) < 12
    assert read_gold(spark, str(tmp_path / "gold")).count() == 60_000


def test_without_adaptive_execution_nothing_is_shuffled_by_state(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    write_gold(skewed(spark), str(tmp_path / "gold"))
    assert len(data_files(tmp_path / "gold" / "state=HOT", ".parquet")) == 12
    assert read_gold(spark, str(tmp_path / "gold")).count() == 60_000


def test_snapshot_is_one_file_with_header_and_empty_nulls(spark, tmp_path):
    df = gold_rows(spark, {"state": "AK", "Discharges": "1,2"}, {"state": "TX"}).repartition(2)
    write_snapshot(df, str(tmp_path / "s"))
    (name,) = data_files(tmp_path / "s", ".csv")
    lines = sorted((tmp_path / "s" / name).read_text().splitlines())
    assert lines == sorted(
        [",".join(GOLD.names), 'AK,0,,"1,2",,,,,,,', "TX,1,,,,,,,,,"]
    )


def test_snapshot_has_one_file_unless_the_caller_says_otherwise(spark, tmp_path, conf):
    conf("spark.sql.files.maxRecordsPerFile", "4")
    df = gold_rows(spark, *({"provider_id": n} for n in range(30))).repartition(3)
    write_snapshot(df, str(tmp_path / "s"))
    assert len(data_files(tmp_path / "s", ".csv")) == 1
    write_snapshot(df, str(tmp_path / "s"), single_file=False)
    assert len(data_files(tmp_path / "s", ".csv")) >= 8


def test_preview_prints_the_first_rows(spark, capsys):
    preview(spark.range(20).select(F.lit("a long text that is not cut off").alias("t")))
    out = capsys.readouterr().out
    assert out.count("not cut off") == 10


def test_paths():
    paths = Paths.under("/data/")
    assert paths.gold == "/data/gold/merged"
    env = {"MEDALLION_ROOT": "/data", "MEDALLION_SNAPSHOT": "/else"}
    assert Paths.from_env(env).gen_info_raw == "/data/raw/gen_info"
    assert Paths.from_env(env).snapshot == "/else"


def test_scratch_lies_in_the_shared_folder(spark):
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


class SessionWithoutSharedFolder:
    """A session whose ``spark.checkpoint.dir`` is not set."""

    def __init__(self, spark, master):
        self.conf = {}
        self.sparkContext = type(
            "Context",
            (),
            {
                "master": master,
                "_jvm": spark.sparkContext._jvm,
                "_jsc": spark.sparkContext._jsc,
            },
        )


def test_only_a_local_session_may_do_without_the_shared_folder(spark):
    folder = scratch_folder(SessionWithoutSharedFolder(spark, "local[2]"), "x")
    assert os.path.isdir(folder)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(SessionWithoutSharedFolder(spark, "yarn"), "x")


def test_discarded_scratch_is_gone(spark):
    folder = scratch_folder(spark, "x")
    spark.range(3).write.mode("overwrite").parquet(folder)
    discard(spark, folder)
    assert not os.path.exists(folder)
