"""Reports of parallel runs, and their time stamps."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.operators import metrics
from tilecast.sources import reports, tables

ROW = (0, 5, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, "aoi", "2020-01-01 00:00:00.000000")


def report(spark, iteration=5, tss=0.1, run=0):
    return spark.createDataFrame([(run, iteration, tss, *ROW[3:])], tables.METRICS)


def test_two_writers_keep_both_rows_and_the_clash_is_named(spark, tmp_path):
    folder = str(tmp_path / "reports")
    reports.write_report(report(spark, tss=0.1), folder, 0, 5, "007")
    reports.write_report(report(spark, iteration=6), folder, 0, 6, "007")
    with pytest.raises(reports.ReportConflict, match="run 0, iteration 5 has reports by 007, east") as caught:
        reports.write_report(report(spark, tss=0.2), folder, 0, 5, "east")
    assert caught.value.writers == ["007", "east"]
    kept = reports.read_reports(spark, folder)
    assert {(r.run, r.iteration, r.writer, r.tss) for r in kept.collect()} == {
        (0, 5, "007", 0.1), (0, 6, "007", 0.1), (0, 5, "east", 0.2),
    }
    assert [tuple(r) for r in reports.conflicts(kept).collect()] == [(0, 5, ["007", "east"])]
    assert tuple(kept.where("iteration = 6").select(*tables.METRICS.names).first()) == (0, 6, *ROW[2:])


def test_a_rerun_replaces_its_own_report_alone(spark, tmp_path):
    folder = str(tmp_path / "reports")
    for tss in (0.1, 0.9):
        reports.write_report(report(spark, tss=tss), folder, 0, 5, "a")
    assert [r.tss for r in reports.read_reports(spark, folder).collect()] == [0.9]


def test_runs_with_names_and_folders_that_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "reports")
    schema = T.StructType([T.StructField("run", T.StringType()), *tables.METRICS.fields[1:]])
    for run in ("x-1", "2"):
        reports.write_report(spark.createDataFrame([(run, *ROW[1:])], schema), folder, run, 5, "a")
    kept = reports.read_reports(spark, folder, schema)
    assert {r.run for r in kept.collect()} == {"x-1", "2"}
    plan = kept.where("run = '2' and iteration = 5")._jdf.queryExecution().executedPlan().toString()
    assert "run" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_of_another_iteration_and_bad_names_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="not of iteration 6"):
        reports.write_report(report(spark), str(tmp_path / "r"), 0, 6, "a")
    for name in ("", "a/b", "_a", "..", "a b"):
        with pytest.raises(ValueError):
            reports.write_report(report(spark), str(tmp_path / "r"), 0, 5, name)


def test_time_of_a_report(spark):
    rows = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1)], "label int, prediction int, score double")
    args = ("label", "prediction", "score", 0, 1, "here")
    fixed = F.lit("2024-02-29 23:59:59.000123").cast("timestamp")
    got = metrics.metrics_report(rows, *args, now=fixed).first().iteration_time
    assert got == "2024-02-29 23:59:59.000123"
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now = metrics.metrics_report(rows, *args).first().iteration_time
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{6}", now)
    assert abs((dt.datetime.fromisoformat(now) - before).total_seconds()) < 60
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        fixed = F.lit("2024-03-01 08:59:59.5").cast("timestamp")
        assert metrics.metrics_report(rows, *args, now=fixed).first().iteration_time == "2024-02-29 23:59:59.500000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
