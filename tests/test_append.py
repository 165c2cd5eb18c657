"""A panel grown month by month equals a full build."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rosterloom.plans.append import append_month, start_panel, state_of
from rosterloom.plans.org import build_organisation, default_blocks
from rosterloom.plans.panel import panel
from rosterloom.plans.roster import PanelSpec, numbered_slots
from rosterloom.sources.panel_io import read_panel

COLUMNS = [
    "report_date", "employee_id", "grade_num", "position_name", "fp_res", "mean_value_completion", "date_since_salary_change_last",
    "sber_los_cnt_days", "all_succesors", "lid_1_lvl_i_pernr", "lid_tribe_i_pernr", "team_code",
]


def test_months_appended_one_by_one(spark, tmp_path):
    """From the first month on, past a year's end and quarters; each month is run twice, one of them out of turn."""
    spec = PanelSpec(months=1, attrition=0.1, job_changes=0.2)
    slots, org = numbered_slots(spark, 60), build_organisation(default_blocks(spark), spec.seed, 5)
    path, state = str(tmp_path / "panel"), str(tmp_path / "state")
    start_panel(spark, slots, org, spec, path, state, COLUMNS)
    for month in (1, 2, 3, 3, 2, 4):
        append_month(spark, slots, org, spec, month, path, state, COLUMNS)
    grown = read_panel(spark, path, spark.read.parquet(path).schema).select(*COLUMNS)
    full = panel(spark, slots, org, replace(spec, months=5), COLUMNS)
    assert grown.count() == 300
    assert sorted(map(str, grown.collect())) == sorted(map(str, full.collect()))
    assert state_of(spark, state, 4).agg(F.count(F.lit(1)), F.count_distinct("emp_no")).first()[:] == (60, 60)
    with pytest.raises(ValueError):
        append_month(spark, slots, org, spec, 0, path, state, COLUMNS)
    with pytest.raises(ValueError):
        append_month(spark, slots, org, spec, 7, path, state, COLUMNS)
