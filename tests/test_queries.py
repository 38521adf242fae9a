"""What registered queries derive and how many tasks they take."""

from __future__ import annotations

import os

from medallion_checks import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_an_empty_publication_needs_no_second_gold(spark, monkeypatch):
    def second(*_):
        raise AssertionError("Gold is made twice")

    monkeypatch.setattr(queries, "published_gold", second)
    assert queries.empty_gold_keeps_old(spark, SF_DIR).count() > 0


def test_the_logged_snapshot_is_read_by_a_bounded_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(queries, "MOST_SPLITS", 3)
    queries.gold_table(spark, SF_DIR)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("logged", "")
    try:
        (found,) = queries.snapshot_logged(spark, SF_DIR).collect()
        jobs = [tracker.getJobInfo(job) for job in sorted(tracker.getJobIdsForGroup("logged"))[-3:]]
        stages = [tracker.getStageInfo(stage) for job in jobs if job for stage in job.stageIds]
        tasks = [stage.numTasks for stage in stages if stage]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found["split"] and found["files"] == 1
    assert max(tasks) < 14, tasks
