"""The 54-column panel: one row per employee and month end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions.draws import pick_draw
from rosterloom.operators.lookups import peer_ordinals, peers_in_period, random_peers, weighted_lookup
from rosterloom.operators.sides import dimension_lookup, spread
from rosterloom.plans.attributes import Attributes
from rosterloom.plans.leaders import leader_or_none, leaf_leaders
from rosterloom.plans.org import Organisation, build_organisation, default_blocks
from rosterloom.plans.roster import PanelSpec, Slots, hire_rows, numbered_slots, roster, with_events
from rosterloom.sources.schema import PANEL, PANEL_COLUMNS
from rosterloom.sources.staging import stored

# Columns that come out of a step of their own; a panel without them leaves the step out.
LEADER_COLUMNS = {
    "po_i_pernr", "lid_tribe_i_pernr", "lid_1_lvl_i_pernr", "lid_2_lvl_i_pernr", "lid_3_lvl_i_pernr",
    "lid_cluster_i_pernr", "it_lid_cluster_i_pernr", "cur_tribe_i_pernr",
}
UNIT_COLUMNS = {
    "unit_id_tree", "full_oshs_name", "position_name", "professionlevel_name", "tribe_name", "cluster_name",
    "team_name", "tribe_code", "cluster_code", "team_code",
} | LEADER_COLUMNS
HIRE_UNIT_COLUMNS = {"all_skills", "lang_with_level", "all_goals_desc", "achievement_desc", "speciality_name"}
EVENT_COLUMNS = {
    "grade_num", "date_since_salary_change_last", "fp_res", "fp_comp", "mean_value_completion",
} | UNIT_COLUMNS
QUARTER_COLUMNS = {"fp_res", "fp_comp", "mean_value_completion"}
PEER_COLUMNS = {"all_succesors"}


def place(held: DataFrame, org: Organisation, spec: PanelSpec) -> DataFrame:
    """Adds the unit an employee sits in this month: leaf_uid, unit_name, unit_level, is_it, path,
    full_name and the agile columns (NULL where the leaf has no team)."""
    u = pick_draw("unit", "emp_no", F.coalesce(F.col("move_month"), F.lit(0)), seed=spec.seed)
    same = ["leaf_uid", "is_it", "path", "full_name", "tribe_name", "tribe_code", "cluster_name", "cluster_code",
            "team_name", "team_code"]
    names = {**{c: c for c in same}, "name": "unit_name", "level": "unit_level"}
    return weighted_lookup(held, u, org.leaves, names, rows=org.max_leaves)


def place_at_hire(held: DataFrame, org: Organisation, spec: PanelSpec) -> DataFrame:
    """Adds hire_is_it: the flavour of the unit at hire, which skills, goals and schooling follow."""
    u = pick_draw("unit", "emp_no", F.lit(0), seed=spec.seed)
    leaves = org.units.where(F.col("level") == 4)
    return weighted_lookup(held, u, leaves, {"is_it": "hire_is_it"}, rows=org.max_leaves)


def panel(
    spark: SparkSession,
    slots: Slots,
    org: Organisation,
    spec: PanelSpec = PanelSpec(),
    columns: Sequence[str] = tuple(PANEL_COLUMNS),
    extra: Sequence[str] = (),
) -> DataFrame:
    """The panel, or some of its columns; steps that no wanted column needs are not planned.

    ``extra`` keeps working columns such as ``month_no``, ``emp_no`` or ``leaf_uid``.
    """
    wanted = set(columns)
    placed_extra = wanted & UNIT_COLUMNS or set(extra) & {"leaf_uid", "path", "is_it", "unit_name"}
    base = roster(spark, slots, spec)
    rows = base
    if wanted & EVENT_COLUMNS or placed_extra or set(extra) & {"title_month", "move_month", "promotions", "raise_month", "quarter_month"}:
        rows = with_events(base, slots, spec)
    return panel_of(rows, slots, org, spec, columns, extra)


def panel_at_hire(
    spark: SparkSession, slots: Slots, org: Organisation, spec: PanelSpec = PanelSpec(), columns: Sequence[str] = tuple(PANEL_COLUMNS)
) -> DataFrame:
    """One row per employee ever hired: the panel's row of the month of hire.  Peers are not known here, nor leaders."""
    if set(columns) & (LEADER_COLUMNS | PEER_COLUMNS):
        raise ValueError("leaders and peers need the whole roster of a month")
    events = bool(set(columns) & (EVENT_COLUMNS - QUARTER_COLUMNS))
    return panel_of(hire_rows(spark, slots, spec, events), slots, org, spec, columns)


def panel_of(
    rows: DataFrame, slots: Slots, org: Organisation, spec: PanelSpec, columns: Sequence[str] = tuple(PANEL_COLUMNS), extra: Sequence[str] = ()
) -> DataFrame:
    """The panel of given roster rows; those of :func:`with_events` where a wanted column depends on events."""
    wanted = set(columns)
    placed_extra = wanted & UNIT_COLUMNS or set(extra) & {"leaf_uid", "path", "is_it", "unit_name"}
    if wanted & (LEADER_COLUMNS | PEER_COLUMNS):
        # Read again for leaders and peers, so computed once; they read a few of its columns.
        rows = stored(rows, "roster")
    held = rows
    attributes = Attributes(spec.seed)
    if wanted & PEER_COLUMNS:
        # Joined while the rows are still narrow: this is the one shuffle of all rows.
        ordinals = peer_ordinals(slots.count, *attributes.successor_draws())
        count = F.least(attributes.successor_count(), slots.count - F.lit(1))
        peers = random_peers(held, "month_no", "slot", "emp_no", "slot_key", ordinals, count)
        rows = spread(rows, "slot_key").join(peers, "slot_key", "left")
    if placed_extra:
        rows = place(rows, org, spec)
        if wanted & LEADER_COLUMNS:
            managers = place(held.where("is_manager"), org, spec)
            rows = dimension_lookup(
                rows,
                leaf_leaders(managers, org.leaves),
                ["month_no", "leaf_uid"],
                rows=None if org.max_leaves is None else org.max_leaves * spec.months,
            )
    if wanted & HIRE_UNIT_COLUMNS or "hire_is_it" in extra:
        rows = place_at_hire(rows, org, spec)
    if wanted & HIRE_UNIT_COLUMNS:
        rows = rows.withColumns(attributes.shuffled())
    built = _expressions(attributes)
    types = {f.name: f.dataType for f in PANEL}
    return rows.select(*[built[c]().cast(types[c]).alias(c) for c in columns], *extra)


def _expressions(a: Attributes) -> dict:
    col = F.col
    return {
        "report_date": lambda: col("report_date"),
        "employee_id": lambda: col("emp_no"),
        "grade_num": a.grade,
        "position_name": a.position,
        "unit_id_tree": lambda: col("path"),
        "person_surname": a.surname,
        "person_name": a.first_name,
        "person_patronimics": a.patronymic,
        "gender": a.gender,
        "age_y": a.age,
        "wrk_email": a.work_email,
        "ext_email": a.external_email,
        "employee_kipphn": a.phone,
        "child_count": a.child_count,
        "family_status": a.family_status,
        "is_on_trial": a.trial,
        "sber_los_cnt_days": a.tenure,
        "is_parental_leave": a.parental_leave,
        "all_skills": a.skills,
        "date_since_salary_change_last": a.raise_days,
        # Leader at the unit's own level, at most the third; every employee sits in a leaf of level 4.
        "po_i_pernr": lambda: leader_or_none(
            F.get(F.array("level1_leader", "level2_leader", "level3_leader"), F.least(col("unit_level"), F.lit(3)) - F.lit(1))
        ),
        "fp_res": a.result_grade,
        "fp_comp": a.competence_grade,
        "full_oshs_name": lambda: col("full_name"),
        "all_succesors": lambda: peers_in_period(col("_peers"), col("month_no"), "month_no", "emp_no"),
        "children_gender": a.children_gender,
        "children_years": a.children_years,
        "lang_with_level": a.languages,
        "tribe_name": lambda: col("tribe_name"),
        "cluster_name": lambda: col("cluster_name"),
        "team_name": lambda: col("team_name"),
        "tribe_code": lambda: col("tribe_code"),
        "cluster_code": lambda: col("cluster_code"),
        "team_code": lambda: col("team_code"),
        "all_goals_desc": a.goals,
        "mean_value_completion": a.current_completion,
        "num_goals": a.goal_count,
        "not_completed_goals": a.open_goals,
        "risked_goals": a.risked_goals,
        "achievement_desc": a.achievements,
        "career_status": a.career_status,
        "university_name": a.university,
        "speciality_name": a.speciality,
        "date_finish_education": a.education_end,
        "lead_experience_years": a.lead_years,
        "professionlevel_name": a.profession,
        "vac_days": a.vacation_days,
        "lid_tribe_i_pernr": lambda: leader_or_none(col("tribe_leader")),
        "lid_1_lvl_i_pernr": lambda: leader_or_none(col("level1_leader")),
        "lid_2_lvl_i_pernr": lambda: leader_or_none(col("level2_leader")),
        "lid_3_lvl_i_pernr": lambda: leader_or_none(col("level3_leader")),
        "lid_cluster_i_pernr": lambda: leader_or_none(col("cluster_leader")),
        "it_lid_cluster_i_pernr": lambda: leader_or_none(col("cluster_leader")),
        "cur_tribe_i_pernr": lambda: leader_or_none(col("tribe_leader")),
    }


def generate_panel(
    spark: SparkSession, n_employees: int = 20_000, spec: PanelSpec = PanelSpec(), blocks: DataFrame | None = None
) -> DataFrame:
    """A whole panel of ``n_employees`` per snapshot under the default blocks, or given ones."""
    known = blocks is None
    org = build_organisation(default_blocks(spark) if known else blocks, spec.seed, 5 if known else None)
    return panel(spark, numbered_slots(spark, n_employees), org, spec)
