"""Sinks, scans, pruning and the job entry points."""

import datetime
import os

from pyspark.sql import functions as F

from rosterloom import jobs
from rosterloom.plans import snapshots
from rosterloom.sources.panel_io import files_for, laid_out, read_panel, read_period, stored_periods, write_bucketed, write_panel
from rosterloom.sources.schema import ARRAY_COLUMNS, PANEL, PANEL_COLUMNS
from rosterloom.sources.staging import scratch, shared_dir, stored


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_generate_and_export(spark, tmp_path):
    out, flat = str(tmp_path / "panel"), str(tmp_path / "flat")
    jobs.main(["generate", "--n", "200", "--months", "3", "--out", out], spark)
    rows = read_panel(spark, out)
    assert rows.columns == PANEL_COLUMNS and rows.count() == 600
    jobs.main(["export", "--parquet", out, "--out", flat, "--sample-employees", "50"], spark)
    kept = spark.read.parquet(flat)
    assert kept.select("employee_id").distinct().count() == 50
    assert all(dict(kept.dtypes)[c] == "string" for c in ARRAY_COLUMNS)
    assert len([f for f in os.listdir(flat) if f.startswith("report_date=20")]) == 3  # the access path by date
    jobs.main(["export", "--parquet", out, "--out", flat], spark)
    assert spark.read.parquet(flat).count() == 600

    # Only the folder of the wanted month is read, and only the wanted columns.
    plan = plan_of(snapshots.grade_profile(rows))
    assert "PartitionFilters: [isnotnull(report_date" in plan
    assert "ReadSchema: struct<grade_num:int,sber_los_cnt_days:int,fp_res:string>" in plan

    # One month is replaced, the others stay.
    month = rows.where("report_date = '2025-11-30'")
    small = spark.createDataFrame(month.limit(5).collect(), rows.schema)
    write_panel(small, out)
    counts = {str(r.report_date): r.headcount for r in snapshots.headcount_by_snapshot(read_panel(spark, out)).collect()}
    assert counts == {"2025-10-31": 200, "2025-11-30": 5, "2025-12-31": 200}


def test_months_are_appended_by_the_job(spark, tmp_path):
    """generate 3 = generate 1 and append 2; the working tables of the jobs are gone afterwards."""
    whole, grown, state = (str(tmp_path / x) for x in ("whole", "grown", "state"))
    before = {f for f in os.listdir(shared_dir(spark)) if f.startswith("roster-")}
    jobs.main(["generate", "--n", "40", "--months", "3", "--out", whole], spark)
    jobs.main(["generate", "--n", "40", "--months", "1", "--out", grown, "--state", state], spark)
    jobs.main(["append", "--n", "40", "--months", "2", "--out", grown, "--state", state], spark)
    assert {f for f in os.listdir(shared_dir(spark)) if f.startswith("roster-")} == before
    assert sorted(map(str, read_panel(spark, grown).collect())) == sorted(map(str, read_panel(spark, whole).collect()))


def test_periods_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2025-10-31", 1), ("2025-12-31", 2), ("2025-12-31", 3), (None, 4)], "d string, v int")
    rows = rows.select(F.to_date("d").alias("report_date"), "v")
    rows.write.partitionBy("report_date").parquet(path)
    os.mkdir(os.path.join(path, "report_date=2026-01-31"))  # a folder without files
    assert stored_periods(spark, path) == [datetime.date(2025, 10, 31), datetime.date(2025, 12, 31)]
    latest, first = read_period(spark, path, schema=rows.schema), read_period(spark, path, 0, rows.schema)
    assert sorted(r.v for r in latest.collect()) == [2, 3] and [r.v for r in first.collect()] == [1]
    assert "(report_date#" in plan_of(latest) and "= 2025-12-31)" in plan_of(latest) and "Subquery" not in plan_of(latest)
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_period(spark, str(empty)).schema == PANEL and read_period(spark, str(empty)).count() == 0


def test_stored_tables_end_with_their_block(spark):
    with scratch(spark):
        inside = stored(spark.range(5).withColumn("x", F.lit(1)), "kept")
        assert inside.select("id").count() == 5 and inside.columns == ["id", "x"]
    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("kept-")]


def test_bucketed_table_needs_no_shuffle(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("employee_id"), F.lit(1).alias("v"))
    write_bucketed(df, "bucketed_members", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = plan_of(spark.table("bucketed_members").groupBy("employee_id").count())
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_members")


def test_fact_sized_steps_use_many_tasks(spark):
    """No window or exchange over all rows of a month, and none in a single partition."""
    from rosterloom.plans.roster import PanelSpec, numbered_slots, roster

    plan = plan_of(roster(spark, numbered_slots(spark, 1000), PanelSpec()))
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "month_no" in line]
    assert windows
    for line in windows:
        keys = line.split("windowspecdefinition(")[1]
        # Ordered row by row: split by range of the draw.  By month alone: only the range totals.
        assert "_bucket" in keys or "last_quarter" in line or "_all" in keys, line


def test_pieces_of_consecutive_months_are_tasks_of_their_own(spark):
    """Hashed, several pieces of a period may meet in one task; numbered, none do."""
    rows = spark.range(30_000).select(
        F.make_date(F.lit(2025), 1 + F.col("id").cast("int") % 6, F.lit(28)).alias("report_date"), F.col("id").cast("string").alias("employee_id")
    )
    tasks = laid_out(rows, ("employee_id",), files_per_period=5, periods=6).groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("report_date").alias("months")
    ).collect()
    assert len(tasks) == 30 and all(t.months == 1 for t in tasks) and sum(t.n for t in tasks) == 30_000
    assert max(t.n for t in tasks) < 1_300
    assert files_for(5_400_000) == 22
