"""Invariants, distributions and determinism of the synthetic panel."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from rosterloom.functions import pools
from rosterloom.operators.lookups import weighted_lookup
from rosterloom.plans.org import BLOCKS_PER_TASK, agile_teams, build_organisation, default_blocks, org_tree
from rosterloom.plans.panel import generate_panel, panel
from rosterloom.plans.roster import PanelSpec, numbered_slots
from rosterloom.sources.schema import PANEL, PANEL_COLUMNS
from rosterloom.sources.staging import materialize

N = 3000


@pytest.fixture(scope="module")
def rows(spark):
    return materialize(generate_panel(spark, N))


def none(df, condition):
    assert df.where(condition).limit(1).count() == 0, condition


def test_schema(rows):
    assert rows.columns == PANEL_COLUMNS and len(PANEL_COLUMNS) == 54
    assert [f.dataType.simpleString() for f in rows.schema] == [f.dataType.simpleString() for f in PANEL]


def test_headcount_is_constant(rows):
    per_month = rows.groupBy("report_date").agg(F.count("*").alias("n"), F.count_distinct("employee_id").alias("ids"))
    found = {r.report_date: (r.n, r.ids) for r in per_month.collect()}
    assert list(sorted(found)) == [
        datetime.date(2025, 10, 31), datetime.date(2025, 11, 30), datetime.date(2025, 12, 31),
        datetime.date(2026, 1, 31), datetime.date(2026, 2, 28), datetime.date(2026, 3, 31),
    ]
    assert set(found.values()) == {(N, N)}


def test_ids_are_dense(rows):
    ids = rows.agg(F.count_distinct("employee_id"), F.min(F.col("employee_id").cast("bigint")), F.max(F.col("employee_id").cast("bigint"))).first()
    assert tuple(ids) == (N + 5 * 45, 10_000_001, 10_000_000 + N + 5 * 45)


@pytest.mark.parametrize(
    "violation",
    [
        "size(unit_id_tree) <> 4",
        "num_goals <> size(all_goals_desc)",
        "child_count <> size(children_gender) OR child_count <> size(children_years)",
        "age_y < 24 AND child_count > 0",
        "is_on_trial <> int(sber_los_cnt_days < 90)",
        "NOT (0 <= risked_goals AND risked_goals <= not_completed_goals AND not_completed_goals <= num_goals)",
        "grade_num NOT BETWEEN 7 AND 17",
        "(tribe_name IS NULL) <> (cluster_name IS NULL) OR (tribe_code IS NULL) <> (team_code IS NULL) OR (tribe_name IS NULL) <> (team_name IS NULL)",
        "po_i_pernr <> lid_3_lvl_i_pernr OR lid_cluster_i_pernr <> it_lid_cluster_i_pernr OR lid_tribe_i_pernr <> cur_tribe_i_pernr",
        "mean_value_completion NOT BETWEEN 0.3 AND 1.0",
        "size(all_succesors) > 3 OR size(array_distinct(all_succesors)) <> size(all_succesors)",
        "size(array_distinct(all_skills)) <> size(all_skills) OR size(all_skills) NOT BETWEEN 3 AND 11",
        "tribe_name IS NULL AND lid_tribe_i_pernr <> 0",
        "(professionlevel_name = 'Line H') <> (position_name LIKE 'Head of cell %')",
        "gender = 'M' AND is_parental_leave = 1",
        "array_contains(transform(all_goals_desc, g -> instr(g, '{x}') > 0), true)",
    ],
)
def test_invariants(rows, violation):
    none(rows, violation)


def test_leaders_are_live_managers(rows):
    managers = rows.where("professionlevel_name = 'Line H'").select(
        "report_date", F.col("employee_id").cast("bigint").alias("leader")
    )
    for column in ("lid_1_lvl_i_pernr", "lid_2_lvl_i_pernr", "lid_3_lvl_i_pernr", "lid_tribe_i_pernr", "lid_cluster_i_pernr"):
        used = rows.where(F.col(column) != 0).select("report_date", F.col(column).alias("leader"))
        assert used.join(managers, ["report_date", "leader"], "left_anti").count() == 0


def test_first_leader_is_the_smallest_id(rows):
    expected = (
        rows.where("professionlevel_name = 'Line H'")
        .groupBy("report_date", F.col("unit_id_tree")[0].alias("uid"))
        .agg(F.min(F.col("employee_id").cast("bigint")).alias("leader"))
    )
    found = rows.select("report_date", F.col("unit_id_tree")[0].alias("uid"), F.col("lid_1_lvl_i_pernr").alias("leader")).distinct()
    assert sorted(map(tuple, expected.collect())) == sorted(map(tuple, found.collect()))


def test_successors_are_colleagues_of_the_month(rows):
    asked = rows.select("report_date", F.explode("all_succesors").alias("employee_id"))
    assert asked.join(rows.select("report_date", "employee_id"), ["report_date", "employee_id"], "left_anti").count() == 0


def test_static_attributes_do_not_change(rows):
    static = ["person_surname", "gender", "age_y", "wrk_email", "child_count", "all_skills", "vac_days", "university_name", "num_goals", "not_completed_goals"]
    assert rows.select("employee_id", *static).distinct().count() == rows.select("employee_id").distinct().count()


def test_weights(rows):
    """Shares at hire lie within four standard errors of the weights."""
    people = rows.dropDuplicates(["employee_id"])
    total = people.count()
    for column, weights in (
        ("gender", pools.GENDER_WEIGHTS), ("family_status", pools.FAMILY_WEIGHTS), ("career_status", pools.CAREER_WEIGHTS),
    ):
        shares = {r[0]: r[1] / total for r in people.groupBy(column).count().collect()}
        for value, weight in weights:
            p = weight / sum(w for _, w in weights)
            assert abs(shares.get(value, 0.0) - p) < 4 * math.sqrt(p * (1 - p) / total), (column, value)


def test_block_shares_and_coverage(rows):
    first = rows.where("report_date = '2025-10-31'")
    shares = {r[0]: r[1] / N for r in first.groupBy(F.substring_index("full_oshs_name", " / ", 1)).count().collect()}
    for name, share in zip(pools.BLOCK_NAMES, pools.BLOCK_SHARES):
        assert abs(shares[name] - share / 100) < 4 * math.sqrt(0.25 / N)
    covered = first.where("tribe_code IS NOT NULL").count() / N
    assert 0.75 < covered < 0.87


def _digest(df):
    parts = [F.to_json(F.col(n)) if t.startswith("array") else F.col(n).cast("string") for n, t in df.dtypes]
    return df.select(F.xxhash64(*parts).alias("h")).agg(F.sum(F.col("h").cast("decimal(38,0)"))).first()[0]


@pytest.mark.parametrize("partitions", [1, 64])
def test_same_data_for_any_partitioning(spark, partitions):
    columns = ["report_date", "employee_id", "grade_num", "tribe_code", "all_skills", "all_succesors", "lid_1_lvl_i_pernr"]

    def build(spec):
        org = build_organisation(default_blocks(spark), spec.seed, 5)
        return _digest(panel(spark, numbered_slots(spark, 300), org, spec, columns))

    base = build(PanelSpec())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert build(PanelSpec()) == base
        if partitions == 1:
            assert build(PanelSpec(seed=7)) != base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_panels(spark):
    spec = PanelSpec()
    org = build_organisation(default_blocks(spark), spec.seed, 5)
    columns = ["report_date", "employee_id", "all_succesors"]
    one_month = panel(spark, numbered_slots(spark, 20), org, PanelSpec(months=1), columns)
    assert one_month.count() == 20
    no_leavers = panel(spark, numbered_slots(spark, 30), org, spec, columns)
    assert no_leavers.select("employee_id").distinct().count() == 30
    alone = panel(spark, numbered_slots(spark, 1), org, spec, columns).collect()
    assert len(alone) == 6 and all(r.all_succesors == [] for r in alone)
    with pytest.raises(ValueError):
        PanelSpec(months=0)


def test_unbounded_organisation_gives_the_same_panel(spark):
    """Without a known bound nothing is broadcast by hint; the shuffled form must agree."""
    spec = PanelSpec()
    columns = ["report_date", "employee_id", "unit_id_tree", "tribe_code", "lid_1_lvl_i_pernr", "lid_cluster_i_pernr", "all_skills"]
    slots = numbered_slots(spark, 400)
    org = build_organisation(default_blocks(spark), spec.seed, 5)
    small = _digest(panel(spark, slots, org, spec, columns))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        open_org = build_organisation(default_blocks(spark), spec.seed)
        assert _digest(panel(spark, slots, open_org, spec, columns)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanged_by_broadcast(df):
    """Names of the plan's nodes below each broadcast, down to the next aggregate."""
    found, todo = [], [(df._jdf.queryExecution().sparkPlan(), False)]
    while todo:
        node, sent = todo.pop()
        name = node.getClass().getSimpleName()
        if sent:
            found.append(name)
        if name == "BroadcastHashJoinExec":
            left = node.buildSide().toString() == "BuildLeft"
            todo += [(node.left(), sent or left), (node.right(), sent or not left)]
        else:
            children = node.children()
            todo += [(children.apply(i), sent and "Aggregate" not in name) for i in range(children.size())]
    return found


def test_units_are_not_broadcast_by_estimate(spark):
    """Units are far more than the size of the blocks lets Spark expect; no driver may collect them."""
    blocks = spark.range(20_000).selectExpr("id AS block_no", "'b' AS name", "id % 2 = 0 AS is_it", "1L AS share")
    tree = org_tree(blocks)
    assert "GenerateExec" not in exchanged_by_broadcast(tree)
    rows = tree.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.get("path", 0)).alias("blocks")).collect()
    assert sum(r.blocks for r in rows) == 20_000 and max(r.blocks for r in rows) <= 2 * BLOCKS_PER_TASK
    leaves = tree.where("level = 4")
    assert "GenerateExec" not in exchanged_by_broadcast(weighted_lookup(spark.range(100), F.col("id"), leaves, {"uid": "leaf"}, bits=16))


def test_agile_teams_are_planned_without_broadcast_units(spark):
    """A broadcast of the units hands all of them, and the steps behind the join, to the few tasks of the blocks."""
    blocks = spark.range(20_000).selectExpr("id AS block_no", "'b' AS name", "id % 2 = 0 AS is_it", "1L AS share")
    assert "GenerateExec" not in exchanged_by_broadcast(agile_teams(org_tree(blocks)))
