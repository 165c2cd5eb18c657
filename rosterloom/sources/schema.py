"""The panel's columns, types and order."""

from __future__ import annotations

from pyspark.sql import types as T

PANEL_DDL = """
report_date date, employee_id string, grade_num int, position_name string, unit_id_tree array<bigint>,
person_surname string, person_name string, person_patronimics string, gender string, age_y int,
wrk_email string, ext_email string, employee_kipphn string, child_count int, family_status int,
is_on_trial int, sber_los_cnt_days int, is_parental_leave int, all_skills array<string>,
date_since_salary_change_last int, po_i_pernr bigint, fp_res string, fp_comp string,
full_oshs_name string, all_succesors array<string>, children_gender array<string>, children_years array<int>,
lang_with_level array<string>, tribe_name string, cluster_name string, team_name string,
tribe_code int, cluster_code int, team_code int, all_goals_desc array<string>,
mean_value_completion double, num_goals int, not_completed_goals int, risked_goals int,
achievement_desc array<string>, career_status string, university_name string, speciality_name string,
date_finish_education string, lead_experience_years int, professionlevel_name string,
vac_days int, lid_tribe_i_pernr bigint, lid_1_lvl_i_pernr bigint, lid_2_lvl_i_pernr bigint,
lid_3_lvl_i_pernr bigint, lid_cluster_i_pernr bigint, it_lid_cluster_i_pernr bigint,
cur_tribe_i_pernr bigint
"""
_TYPES: dict[str, T.DataType] = {
    "date": T.DateType(), "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "array<string>": T.ArrayType(T.StringType()), "array<bigint>": T.ArrayType(T.LongType()),
    "array<int>": T.ArrayType(T.IntegerType()),
}
# Declared without a running session, so that modules can be imported before one exists.
PANEL = T.StructType(
    [T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in PANEL_DDL.replace("\n", " ").split(","))]
)
PANEL_COLUMNS: list[str] = PANEL.fieldNames()
ARRAY_COLUMNS: list[str] = [f.name for f in PANEL if isinstance(f.dataType, T.ArrayType)]
PERIOD, MEMBER = "report_date", "employee_id"
