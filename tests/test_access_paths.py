"""Layouts for lookups: what a scan skips, and that it finds the same rows."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rosterloom.functions.draws import draw
from rosterloom.plans import testbed
from rosterloom.sources import access_paths as paths


def scans(df):
    """The file scans of an executed plan, those of subqueries left out."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    leaves, found = [plan], []
    while leaves:
        node = leaves.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            leaves.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append(node)
        children = node.children()
        leaves += [children.apply(i) for i in range(children.size())]
    return found


def metric(scan, name):
    return scan.metrics().apply(name).value()


def row_groups(folder):
    return sum(pq.ParquetFile(f).num_row_groups for f in folder.rglob("*.parquet"))


@pytest.fixture(scope="module")
def people(spark):
    """40,000 rows: two months, ids in no order, 50 tribes, 200 positions."""
    month = F.make_date(F.lit(2025), 1 + F.col("id") % 2, F.lit(28))
    u = F.pmod(F.xxhash64("id"), F.lit(50))
    return spark.range(40_000).select(
        month.alias("report_date"), F.concat(F.lit("E"), F.lpad((F.floor(F.col("id") / 2) * 7919 % 20_000).cast("string"), 6, "0")).alias("employee_id"),
        F.when(u > 0, u).cast("int").alias("tribe_code"), F.concat(F.lit("P"), draw("position", "id") % 200).alias("position_name"), F.col("id").alias("v"),
    )


def test_splitters_and_ordinals(spark):
    assert paths.splitters([], 2) == paths.splitters([None, 5, 5], 2) == []
    assert paths.splitters(range(100), 2) == [25, 50, 75]
    assert paths.splitters([1] * 80 + [2] * 20, 3) == [2]
    df = spark.createDataFrame([(None,), (0,), (24,), (25,), (74,), (75,), (99,)], "x int")
    assert [r.o for r in df.select(paths.ordinal(F.col("x"), [25, 50, 75], 2).alias("o")).collect()] == [0, 0, 0, 1, 2, 3, 3]
    both = spark.range(1).select(paths.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z"))
    assert both.first().z == 0b100111
    with pytest.raises(ValueError):
        paths.interleaved([F.lit(1)] * 11, 6)


def test_row_groups_read_for_one_value(spark, people, tmp_path):
    columns = ["employee_id", "tribe_code", "position_name"]
    paths.write_clustered(people, str(tmp_path), columns, rows_per_file=5_000, row_group_bytes=16_000)
    table = spark.read.parquet(str(tmp_path))
    groups = row_groups(tmp_path)
    assert groups >= 40 and table.count() == 40_000
    per_group = 40_000 / groups
    most = {"employee_id": 0.15, "tribe_code": 0.6, "position_name": 0.6}
    for column, value in (("employee_id", "E000123"), ("tribe_code", 7), ("position_name", "P17")):
        hit = table.where(F.col(column) == value).select("v")
        found = sorted(r.v for r in hit.collect())
        assert found == sorted(r.v for r in people.where(F.col(column) == value).select("v").collect()) and found
        read = metric(scans(hit)[0], "numOutputRows") / per_group
        assert read <= most[column] * groups, (column, read, groups)
    assert table.where("employee_id = 'nobody'").count() == 0


def test_member_chosen_at_run_time(spark, people, tmp_path):
    paths.write_by_member(people, str(tmp_path), 16, rows_per_file=2_000, row_group_bytes=16_000)
    table = paths.read_by_member(spark, str(tmp_path), people.schema)
    chosen = people.where("employee_id like 'E0004%'").select(F.max("employee_id").alias("employee_id"))
    hit = paths.rows_of_member(table, chosen).orderBy("report_date")
    rows = hit.collect()
    assert hit.columns == people.columns and [r.employee_id for r in rows] == ["E000499"] * 2
    scan = scans(hit)[0]
    assert metric(scan, "numPartitions") == 1 and metric(scan, "numOutputRows") <= 1_500
    assert [r.v for r in paths.rows_of_member(table, "E000499").orderBy("report_date").collect()] == [r.v for r in rows]
    assert paths.rows_of_member(table, chosen.where("false")).count() == 0


def test_history_is_one_pass_over_one_folder(spark, sf_dir):
    hit = testbed.one_history(spark, sf_dir)
    plan = hit._sc._jvm.PythonSQLUtils.explainString(hit._jdf.queryExecution(), "formatted")
    pruned = [line for line in plan.splitlines() if line.startswith("PartitionFilters") and "member_bucket" in line]
    assert pruned and "Subquery" in pruned[0]
    assert len(hit.collect()) == 6
    (scan,) = scans(hit)
    assert metric(scan, "numPartitions") == 1


@pytest.mark.parametrize("write", [lambda df, path: paths.write_by_member(df, path, 4), lambda df, path: paths.write_clustered(df, path, ["employee_id"])])
def test_no_task_gathers_many_rows(spark, people, tmp_path, write):
    """A task that sorts wide rows gets a few hundred thousand at most, however many there are in all."""
    copies = people.select("report_date", "employee_id").join(spark.range(25).select(F.col("id").alias("copy")))
    write(copies, str(tmp_path))
    files = [pq.ParquetFile(f).metadata.num_rows for f in tmp_path.rglob("*.parquet")]
    assert sum(files) == 1_000_000
    by_task = spark.read.parquet(str(tmp_path)).groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).count().collect()
    assert max(r["count"] for r in by_task) <= 500_000
