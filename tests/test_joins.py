from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from frames import physical_plan_of, rows
from medallion.operators import joins
from medallion.operators.joins import (
    fits_broadcast,
    join_facilities,
    right_join_facilities,
    salted_join,
)

WAYS = {
    "broadcast": {},
    "shuffled": {"broadcast_limit": 0},
    "salted": {"broadcast_limit": 0, "rows_per_task": 3},
}


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """Measures with a third of the rows on one key, repeats, nulls and partners missing."""
    rng = random.Random(7)
    left = [(5, "same") for _ in range(100)]
    left += [(rng.randrange(40), f"m{n}") for n in range(180)]
    left += [(None, f"n{n}") for n in range(20)]
    right = [(n, f"f{n}") for n in range(20, 60)]
    right += [(5, "f5"), (5, "f5"), (5, "again")]
    right += [(None, "none")] * 12 + [(77, "alone")] * 9
    rng.shuffle(left)
    folder = tmp_path_factory.mktemp("sides")
    spark.createDataFrame(left, "k long, m string").repartition(6).write.parquet(f"{folder}/l")
    spark.createDataFrame(right, "k long, f string").repartition(3).write.parquet(f"{folder}/r")
    return spark.read.parquet(f"{folder}/l"), spark.read.parquet(f"{folder}/r")


@pytest.mark.parametrize("way", WAYS)
def test_inner_join(sides, way):
    left, right = sides
    expected = left.join(right, "k")
    got = join_facilities(left, right, "k", **WAYS[way])
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("way", WAYS)
def test_right_join(sides, way):
    left, right = sides
    expected = left.join(right, "k", "right")
    got = right_join_facilities(left, right, "k", **WAYS[way])
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task", [1, 20, 10_000])
def test_salted_join_equals_plain_join(sides, how, rows_per_task):
    left, right = sides
    got = salted_join(left, right, "k", how, rows_per_task)
    assert rows(got) == rows(left.join(right, "k", how))


@pytest.mark.parametrize("rows_per_task", [1, 4, 30])
def test_keys_hot_on_the_other_side_or_on_both(sides, rows_per_task, conf):
    left, right = sides
    conf("spark.sql.shuffle.partitions", "5")
    expected = rows(right.join(left, "k"))
    assert rows(salted_join(right, left, "k", "inner", rows_per_task)) == expected


def test_both_sides_are_split_in_an_inner_join(sides):
    left, right = sides
    plan = physical_plan_of(salted_join(left, right, "k", "inner", 2))
    assert "__left_salt" in plan and "__right_salt" in plan
    plan = physical_plan_of(salted_join(left, right, "k", "left_anti", 2))
    assert "__left_salt" in plan and "__right_salt" not in plan


def test_no_partner_on_either_side(spark):
    left = spark.createDataFrame([(1, "m")], "k long, m string")
    none = spark.createDataFrame([], "k long, f string")
    for options in WAYS.values():
        assert rows(right_join_facilities(left, none, "k", **options)) == []
        alone = right_join_facilities(
            left.filter("false"), spark.createDataFrame([(1, "f")], none.schema), "k", **options
        )
        assert rows(alone) == [(1, None, "f")]


def test_hot_key_is_spread_even_when_its_rows_are_identical(sides):
    left, _ = sides
    hot = joins.hot_keys(left, "k", 20)
    assert [r.k for r in hot.collect()] == [5]
    salts = hot.first()["__salts"]
    assert salts == -(-left.filter("k = 5").count() // 20)
    spread = joins._spread(left.filter("k = 5"), hot, "k", "salt").groupBy("salt").count()
    assert spread.count() == salts


@pytest.mark.parametrize("stride", [1, 4, 5])
def test_a_regular_row_order_does_not_pile_a_key_up(spark, tmp_path, stride):
    hot_row = F.col("id") % stride == 0
    table = spark.range(40_000).select(F.when(hot_row, 7).otherwise(F.col("id")).alias("k"))
    table.repartition(1).sort("k").write.parquet(str(tmp_path / "sorted"))
    table.coalesce(1).write.parquet(str(tmp_path / "plain"))
    for name in ("sorted", "plain"):
        df = spark.read.parquet(str(tmp_path / name))
        hot = joins.hot_keys(df, "k", 40_000 // stride // 4)
        counts = joins._spread(df, hot, "k", "salt").filter("k = 7").groupBy("salt").count()
        sizes = [r["count"] for r in counts.collect()]
        assert len(sizes) >= 4 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_salts_are_bounded_by_rows_per_task_alone(sides, conf):
    left, right = sides
    conf("spark.sql.shuffle.partitions", "4")
    hot = {r["k"]: r["__salts"] for r in joins.hot_keys(left, "k", 1).collect()}
    counts = {r["k"]: r["count"] for r in left.filter("k is not null").groupBy("k").count().collect()}
    assert hot == {k: n for k, n in counts.items() if n > 1}
    assert rows(salted_join(left, right, "k", "inner", 1)) == rows(left.join(right, "k"))


@pytest.mark.parametrize("rows_per_task", [1, 2, 5, 40, 900])
def test_a_sketch_finds_the_hot_keys_that_a_full_count_finds(spark, tmp_path, rows_per_task):
    rng = random.Random(rows_per_task)
    keys = [int(rng.paretovariate(0.7)) for _ in range(30_000)] + [None] * 500
    spark.createDataFrame([(k,) for k in keys], "k long").repartition(5).write.parquet(str(tmp_path / "k"))
    df = spark.read.parquet(str(tmp_path / "k"))
    hot = {r["k"]: r["__salts"] for r in joins.hot_keys(df, "k", rows_per_task).collect()}
    counts = Counter(k for k in keys if k is not None)
    assert hot == {k: -(-n // rows_per_task) for k, n in counts.items() if n > rows_per_task}


def test_hot_text_keys_and_no_hot_keys(spark):
    df = spark.createDataFrame([(f"k{n % 7}",) for n in range(700)] + [("x",)], "k string")
    assert {r["k"] for r in joins.hot_keys(df, "k", 99).collect()} == {f"k{n}" for n in range(7)}
    assert joins.hot_keys(df, "k", 100) is None and joins.hot_keys(df, "k", 701) is None
    assert joins.hot_keys(df.filter("false"), "k", 1) is None


def test_nothing_is_measured_twice(sides, monkeypatch):
    left, right = sides
    seen = []
    real = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda df, *a: seen.append(df) or real(df, *a))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a: seen.append("size") or False)
    right_join_facilities(left, right, "k", rows_per_task=3)
    assert len(seen) == 3 and seen.count("size") == 1
    seen.clear()
    right_join_facilities(left, right, "k", broadcast=False, rows_per_task=3)
    assert len(seen) == 2


def test_the_facility_side_is_broadcast_only_within_the_limit(sides):
    left, right = sides
    small = physical_plan_of(join_facilities(left, right, "k"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    size = right.count() * (64 + 8) + right.agg(F.sum(F.octet_length("f"))).first()[0]
    assert fits_broadcast(right, size)
    assert not fits_broadcast(right, size - 1)
    large = physical_plan_of(join_facilities(left, right, "k", broadcast_limit=size - 1))
    assert "SortMergeJoin" in large


def test_compressed_size_does_not_count_as_proof(spark, tmp_path):
    copies = spark.range(200_000).select(F.lit(1).cast("long").alias("k"), F.lit("f").alias("f"))
    copies.coalesce(1).write.parquet(str(tmp_path / "copies"))
    df = spark.read.parquet(str(tmp_path / "copies"))
    limit = 1_000_000
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < limit
    assert not fits_broadcast(df, limit)


def test_no_right_outer_shuffle_of_the_measures(sides):
    left, right = sides
    plan = physical_plan_of(right_join_facilities(left, right, "k"))
    assert "SortMergeJoin" not in plan and "RightOuter" not in plan
