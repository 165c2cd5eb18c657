"""The operators wired to the benchmark tables.

The panel's slots are the rows of ``customer``; the blocks of its organisation are the rows of
``region``.  A second organisation has one block per ``supplier``, so that the dimension jobs
grow with the data as well.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions import pools
from rosterloom.functions.dates import is_quarter_end, month_end, month_ends
from rosterloom.functions.draws import pick_draw, chance, distinct_picks, draw, pick, uniform_decimal, uniform_int, weighted, wide_draw
from rosterloom.functions.scores import half_even
from rosterloom.functions.text import (
    by_key, contains_pattern, json_array, json_first, last_token, prefix_before, strip_leading_word,
)
from rosterloom.operators.alias import alias_pick, alias_table
from rosterloom.operators.lookups import weighted_lookup, with_ancestors
from rosterloom.operators.presence import always_there, presence_bitmaps, turnover_of_all_pairs
from rosterloom.operators.ranking import even_bucket, greedy_cover, sample_exactly, with_rank
from rosterloom.operators.trees import tour
from rosterloom.plans import export, snapshots
from rosterloom.plans.append import append_month, start_panel
from rosterloom.plans.attributes import Attributes
from rosterloom.plans.leaders import agile_leaders, unit_leaders
from rosterloom.plans.org import Organisation, agile_teams, build_organisation, org_tree
from rosterloom.plans.panel import panel, panel_at_hire, place
from rosterloom.plans.roster import PanelSpec, Slots, leavers, roster, slots_from_keys, with_events
from rosterloom.sources.access_paths import read_by_member, rows_of_member, write_by_member, write_clustered
from rosterloom.sources.panel_io import files_for, read_panel, read_period, stored_periods, write_panel
from rosterloom.sources.schema import PANEL, PANEL_COLUMNS
from rosterloom.sources.staging import materialize, scratch, staging_path

SPEC = PanelSpec()
SAMPLE = 500
_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Dimension tables and the stored panel are built once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- inputs of the panel -------------------------------------------------------


def region_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.pmod(F.col("r_regionkey"), F.lit(len(pools.BLOCK_SHARES)))
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("block_no"),
        F.concat(F.lit("Sector "), F.col("r_name")).alias("name"),
        by_key(number, dict(enumerate(pools.BLOCK_IS_IT))).alias("is_it"),
        by_key(number, dict(enumerate(pools.BLOCK_SHARES))).cast("bigint").alias("share"),
    )


def supplier_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("block_no"),
        F.concat(F.lit("Sector "), F.col("s_name")).alias("name"),
        (F.col("s_nationkey") % 5 == 0).alias("is_it"),
        (F.lit(1) + F.col("s_nationkey") % 7).cast("bigint").alias("share"),
    )


def organisation(spark: SparkSession, sf_dir: str) -> Organisation:
    def build() -> Organisation:
        blocks = region_blocks(spark, sf_dir)
        return build_organisation(blocks, SPEC.seed, max_blocks=blocks.count())

    return _once(spark, sf_dir, "organisation", build)


def supplier_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "supplier_units", lambda: materialize(org_tree(supplier_blocks(spark, sf_dir), SPEC.seed))
    )


def slots(spark: SparkSession, sf_dir: str) -> Slots:
    return slots_from_keys(table(spark, sf_dir, "customer"), "c_custkey", SPEC.seed)


def live_panel(spark: SparkSession, sf_dir: str, columns, extra=()) -> DataFrame:
    """Panel columns straight from the input tables."""
    return panel(spark, slots(spark, sf_dir), organisation(spark, sf_dir), SPEC, columns, extra)


def panel_path(spark: SparkSession, sf_dir: str) -> str:
    """The panel as a Parquet table, one folder per month."""

    def build() -> str:
        path = staging_path(spark, "panel")
        with scratch(spark):
            write_panel(live_panel(spark, sf_dir, PANEL_COLUMNS), path)
        return path

    return _once(spark, sf_dir, "panel", build)


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_panel(spark, panel_path(spark, sf_dir))


def latest_stored_month(spark, sf_dir):
    """Headcount by tribe in the latest stored month; which one that is, and how many there are, folder names tell."""
    path = panel_path(spark, sf_dir)
    months = stored_periods(spark, path)
    rows = read_period(spark, path).groupBy("report_date", "tribe_code").agg(F.count(F.lit(1)).alias("headcount"))
    return rows.select("*", F.lit(months[0]).alias("first_month"), F.lit(len(months)).cast("bigint").alias("n_months"))


ACCESS_COLUMNS = ("employee_id", "tribe_code", "cluster_code", "position_name")
MEMBER_BUCKETS = 32


def clustered_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored panel sorted by a space-filling key of employee, tribe, cluster and position."""

    def build() -> str:
        path = staging_path(spark, "panel-clustered")
        write_clustered(stored_panel(spark, sf_dir), path, ACCESS_COLUMNS)
        return path

    return read_panel(spark, _once(spark, sf_dir, "clustered", build))


def panel_by_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored panel in a folder per bucket of employees."""

    def build() -> str:
        path = staging_path(spark, "panel-by-member")
        write_by_member(stored_panel(spark, sf_dir), path, MEMBER_BUCKETS)
        return path

    return read_by_member(spark, _once(spark, sf_dir, "by_member", build), PANEL)


def texts(df: DataFrame) -> DataFrame:
    """Array columns as JSON text."""
    return df.select(*[json_array(F.col(n)).alias(n) if t.startswith("array") else n for n, t in df.dtypes])


def at_hire(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    """One row per employee: the month of hire."""
    return texts(panel_at_hire(spark, slots(spark, sf_dir), organisation(spark, sf_dir), SPEC, ["employee_id", *columns]))


# -- the roster and its events --------------------------------------------------


def panel_roster(spark, sf_dir):
    rows = roster(spark, slots(spark, sf_dir), SPEC)
    return rows.select(
        "report_date", F.col("emp_no").alias("employee_id"), "slot", F.col("slot_key"),
        F.col("hire_month").cast("bigint").alias("hire_month"), F.col("is_manager").cast("int").alias("is_manager"),
    )


def roster_turnover(spark, sf_dir):
    """Headcount, leavers and hires per month."""
    s = slots(spark, sf_dir)
    held = roster(spark, s, SPEC)
    gone = leavers(s, SPEC).groupBy("month_no").agg(F.count(F.lit(1)).alias("left_company"))
    return (
        held.groupBy("report_date", "month_no")
        .agg(
            F.count(F.lit(1)).alias("headcount"),
            F.count(F.when((F.col("hire_month") == F.col("month_no")) & (F.col("month_no") > 0), 1)).alias("hired"),
        )
        .join(F.broadcast(gone), "month_no", "left")
        .select("report_date", "headcount", F.coalesce("left_company", F.lit(0)).alias("left_company"), "hired")
        .orderBy("report_date")
    )


def tenure(spark, sf_dir):
    rows = roster(spark, slots(spark, sf_dir), SPEC)
    a = Attributes(SPEC.seed)
    return rows.select(
        "report_date", F.col("emp_no").alias("employee_id"), a.hire_date().alias("hire_date"),
        a.tenure().alias("tenure_days"), a.trial().alias("is_on_trial"),
    )


def _evolved(spark, sf_dir):
    s = slots(spark, sf_dir)
    return with_events(roster(spark, s, SPEC), s, SPEC)


def raise_counter(spark, sf_dir):
    return _evolved(spark, sf_dir).select(
        "report_date", F.col("emp_no").alias("employee_id"), F.col("raise_month").cast("int").alias("raise_month"),
        Attributes(SPEC.seed).raise_days().alias("days_since_raise"),
    )


def quarter_refresh(spark, sf_dir):
    a = Attributes(SPEC.seed)
    return _evolved(spark, sf_dir).select(
        "report_date", F.col("emp_no").alias("employee_id"), F.col("quarter_month").cast("int").alias("quarter_month"),
        a.result_grade().alias("fp_res"), a.competence_grade().alias("fp_comp"),
        a.current_completion().alias("mean_value_completion"),
    )


def unit_moves(spark, sf_dir):
    return place(_evolved(spark, sf_dir), organisation(spark, sf_dir), SPEC).select(
        "report_date", F.col("emp_no").alias("employee_id"), F.col("title_month").cast("int").alias("title_month"),
        F.col("move_month").cast("int").alias("move_month"), "leaf_uid",
    )


def grade_growth(spark, sf_dir):
    a = Attributes(SPEC.seed)
    return _evolved(spark, sf_dir).select(
        "report_date", F.col("emp_no").alias("employee_id"), a.base_grade().cast("int").alias("base_grade"),
        F.col("promotions").cast("int").alias("promotions"), a.grade().alias("grade_num"),
    )


# -- attributes ------------------------------------------------------------------


def seeded_draw(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", draw("trial", "c_custkey").alias("u"), draw("trial", "c_custkey", "c_nationkey").alias("u_pair"),
        draw("trial", "c_custkey", seed=7).alias("u_other_seed"),
    )


def base_attributes(spark, sf_dir):
    return at_hire(
        spark, sf_dir,
        ["age_y", "child_count", "family_status", "is_parental_leave", "vac_days", "university_name",
         "speciality_name", "date_finish_education", "lead_experience_years", "career_status", "num_goals",
         "mean_value_completion"],
    )


def weighted_category(spark, sf_dir):
    """Weighted picks for every order; one weight set holds NULL, one depends on another column."""
    u = draw("segment", "o_orderkey")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        weighted(draw("gender", "o_orderkey"), pools.GENDER_WEIGHTS).alias("gender"),
        weighted(draw("career", "o_orderkey"), pools.CAREER_WEIGHTS).alias("career_status"),
        F.when(urgent, weighted(u, pools.ENGLISH_IT_WEIGHTS))
        .otherwise(weighted(u, pools.ENGLISH_BANK_WEIGHTS))
        .alias("level"),
        chance(draw("flag", "o_orderkey"), 0.04).cast("int").alias("flag"),
        uniform_int(draw("days", "o_orderkey"), 0, 28).alias("days"),
        uniform_decimal(draw("share", "o_orderkey"), 3000, 10000, 4).alias("share"),
        pick(draw("school", "o_orderkey"), pools.UNIVERSITIES).alias("school"),
    )


def person_names(spark, sf_dir):
    return at_hire(spark, sf_dir, ["gender", "person_surname", "person_name", "person_patronimics"])


def contacts(spark, sf_dir):
    return at_hire(spark, sf_dir, ["wrk_email", "ext_email", "employee_kipphn"])


def skill_sets(spark, sf_dir):
    return at_hire(spark, sf_dir, ["all_skills", "lang_with_level", "achievement_desc"])


def children_arrays(spark, sf_dir):
    return at_hire(spark, sf_dir, ["child_count", "children_gender", "children_years"])


def goal_shortfall(spark, sf_dir):
    return at_hire(spark, sf_dir, ["all_goals_desc", "num_goals", "not_completed_goals", "risked_goals"])


# -- organisation ------------------------------------------------------------------


def org_units(spark, sf_dir):
    return org_tree(supplier_blocks(spark, sf_dir), SPEC.seed).select(
        "uid", "parent_uid", "level", "name", F.col("is_it").cast("int").alias("is_it")
    )


def org_paths(spark, sf_dir):
    return texts(supplier_units(spark, sf_dir).select("uid", F.get("path", 0).alias("l1_uid"), "path", "full_name"))


def block_shares(spark, sf_dir):
    return supplier_units(spark, sf_dir).where("level = 4").select(
        "uid", "raw_weight", F.round("weight", 12).alias("weight"), "pick_low", "pick_high"
    )


def cover(spark, sf_dir):
    """Parts taken in random order until 80% of the total size is reached."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("p_size"), draw("cover", "p_partkey").alias("u")
    )
    return greedy_cover(parts, "p_size", "u", "p_partkey", (80, 100)).select("p_partkey", "p_size", "u")


def agile_structure(spark, sf_dir):
    return agile_teams(supplier_units(spark, sf_dir), SPEC.seed).select(
        "leaf_uid", "tribe_code", "cluster_code", "team_code"
    )


def templated_labels(spark, sf_dir):
    teams = agile_teams(supplier_units(spark, sf_dir), SPEC.seed)
    return teams.select("team_code", "tribe_name", "cluster_name", "team_name")


def agile_assignment(spark, sf_dir):
    return live_panel(
        spark, sf_dir, ["report_date", "employee_id", "tribe_name", "tribe_code", "cluster_code", "team_name", "team_code"]
    )


def weighted_assignment(spark, sf_dir):
    """Every order is given a leaf of the supplier organisation, by leaf weight."""
    leaves = supplier_units(spark, sf_dir).where("level = 4")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return weighted_lookup(orders, pick_draw("assign", "o_orderkey"), leaves, {"uid": "leaf_uid"})


def leaf_aliases(spark, sf_dir):
    return _once(spark, sf_dir, "leaf_aliases", lambda: alias_table(supplier_units(spark, sf_dir).where("level = 4"), "uid", "raw_weight"))


def alias_assignment(spark, sf_dir):
    """Every order is given a leaf of the supplier organisation, by raw weight, through an alias table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    slots_and_count = leaf_aliases(spark, sf_dir)
    return alias_pick(orders, wide_draw("alias_slot", "o_orderkey"), pick_draw("alias_cut", "o_orderkey"), *slots_and_count, "leaf_uid")


def subtree_headcount(spark, sf_dir):
    rows = live_panel(spark, sf_dir, ["report_date", "unit_id_tree"])
    return with_ancestors(rows, "unit_id_tree", "uid").groupBy("report_date", "uid").agg(F.count(F.lit(1)).alias("headcount"))


CHAIN = 1000


def deep_subtree_headcount(spark, sf_dir):
    """Orders under every customer of a deep tree: a chain of the first ones, the others hung below earlier ones by draw."""
    key = F.col("c_custkey")
    parent = F.when(key.between(2, CHAIN), key - 1).when(key > CHAIN, F.lit(1) + draw("below", "c_custkey") % (key - 1))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    nodes = table(spark, sf_dir, "customer").select("c_custkey", parent.alias("parent")).join(orders, "c_custkey", "left")
    found = tour(nodes, ["orders"], "c_custkey", "parent")
    return found.select(F.col("node").alias("c_custkey"), "first", "last", "depth", F.col("size").alias("units"), "orders")


def _managers(spark, sf_dir):
    s = slots(spark, sf_dir)
    held = with_events(roster(spark, s, SPEC), s, SPEC)
    return place(held.where("is_manager"), organisation(spark, sf_dir), SPEC)


def led_units(spark, sf_dir):
    return unit_leaders(_managers(spark, sf_dir), "report_date")


def led_groups(spark, sf_dir):
    managers = _managers(spark, sf_dir)
    return (
        agile_leaders(managers, "tribe_code", "report_date").select("report_date", F.lit("tribe").alias("kind"), F.col("tribe_code").alias("code"), "leader")
        .unionByName(agile_leaders(managers, "cluster_code", "report_date").select("report_date", F.lit("cluster").alias("kind"), F.col("cluster_code").alias("code"), "leader"))
    )


def leader_columns(spark, sf_dir):
    return live_panel(
        spark, sf_dir,
        ["report_date", "employee_id", "po_i_pernr", "lid_1_lvl_i_pernr", "lid_2_lvl_i_pernr", "lid_3_lvl_i_pernr",
         "lid_tribe_i_pernr", "lid_cluster_i_pernr", "it_lid_cluster_i_pernr", "cur_tribe_i_pernr"],
    )


def peers(spark, sf_dir):
    return texts(live_panel(spark, sf_dir, ["report_date", "employee_id", "all_succesors"]))


# -- whole panel -----------------------------------------------------------------------


def panel_rows(spark, sf_dir):
    return texts(live_panel(spark, sf_dir, PANEL_COLUMNS))


def scan_panel(spark, sf_dir):
    return texts(stored_panel(spark, sf_dir))


def panel_roundtrip(spark, sf_dir):
    """Writes the panel in pieces of a given number of rows and reads it back."""
    s = slots(spark, sf_dir)
    rows = live_panel(spark, sf_dir, PANEL_COLUMNS)
    path = staging_path(spark, "roundtrip")
    write_panel(rows, path, files_per_period=files_for(s.keys.count()), periods=SPEC.months)
    return read_panel(spark, path).groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("employee_id").alias("members"),
        F.sum(F.size("all_skills")).alias("skills"), F.sum("grade_num").alias("grades"),
        F.count("tribe_code").alias("in_tribe"), F.sum("lid_1_lvl_i_pernr").alias("leader_sum"),
    )


def appended_month(spark, sf_dir):
    """The last two months of the panel, each made from the stored state of the month before."""

    def build() -> str:
        path, state = staging_path(spark, "grown"), staging_path(spark, "grown-state")
        parts = slots(spark, sf_dir), organisation(spark, sf_dir)
        with scratch(spark):
            start_panel(spark, *parts, replace(SPEC, months=SPEC.months - 2), path, state)
            for month in (SPEC.months - 2, SPEC.months - 1):
                append_month(spark, *parts, SPEC, month, path, state)
        return path

    rows = read_panel(spark, _once(spark, sf_dir, "grown", build))
    return texts(rows.where(F.col("report_date") > month_end(F.lit(SPEC.start), F.lit(SPEC.months - 3))))


def flat_export(spark, sf_dir):
    path = staging_path(spark, "flat")
    return export.export_flat(stored_panel(spark, sf_dir), path, n_members=SAMPLE, key=F.col("employee_id").cast("bigint"))


def flat_table(spark, sf_dir):
    """The whole panel in the flat form, written once per session: paths are JSON text, periods ISO text."""

    def build() -> tuple[str, object]:
        path = staging_path(spark, "flat-all")
        return path, export.export_flat(stored_panel(spark, sf_dir), path).schema

    path, schema = _once(spark, sf_dir, "flat", build)
    return spark.read.schema(schema).parquet(path)


def flat_org_headcount(spark, sf_dir):
    return snapshots.org_headcount(flat_table(spark, sf_dir))


def flat_skill_holders(spark, sf_dir):
    return snapshots.skill_holders(flat_table(spark, sf_dir), "Python")


def flat_skill_popularity(spark, sf_dir):
    return snapshots.skill_popularity(flat_table(spark, sf_dir))


def flat_top_groups(spark, sf_dir):
    return snapshots.top_groups(flat_table(spark, sf_dir))


def part_picks(spark, sf_dir):
    """Five distinct parts for every customer, out of all parts: ordinals of a keyed permutation, joined with the numbered parts."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("p_partkey"))
    numbered = with_rank(parts, "ordinal", ["p_partkey"], even_bucket(parts, "p_partkey"))
    picks = distinct_picks(5, parts.count(), "parts", "c_custkey")
    chosen = table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(picks).alias("place", "ordinal"))
    return chosen.join(numbered, "ordinal").select("c_custkey", "place", "p_partkey")


# -- samples -----------------------------------------------------------------------------


def exact_k_sample(spark, sf_dir):
    """As many orders per priority as there are regions times 100."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", draw("sample", "o_orderkey").alias("u")
    )
    k = table(spark, sf_dir, "region").select(F.count(F.lit(1)) * F.lit(100)).scalar()
    return sample_exactly(orders, k, "u", "o_orderkey", ["o_orderpriority"])


def exact_k_sample_nullable(spark, sf_dir):
    """The same over order states, one of which is unknown."""
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("grp")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", state, draw("sample", "o_orderkey").alias("u"))
    k = table(spark, sf_dir, "region").select(F.count(F.lit(1)) * F.lit(100)).scalar()
    return sample_exactly(orders, k, "u", "o_orderkey", ["grp"])


def price_rank(spark, sf_dir):
    """Place of every order by price, cheapest first; ranges come from the prices, no task orders all rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    ranked = with_rank(orders, "place", ["cents", "o_orderkey"], even_bucket(orders, "cents"))
    return ranked.select("o_orderkey", "cents", F.col("place").cast("bigint").alias("place"))


def entity_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return export.entity_sample(orders, SAMPLE, "o_custkey")


# -- text, JSON and dates on the raw tables --------------------------------------------------


def month_spine_of_orders(spark, sf_dir):
    """Month ends from each customer's first order to the last one, with the orders in each month."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.last_day(F.col("o_orderdate").cast("date")).alias("month_end"))
    counted = orders.groupBy("o_custkey", "month_end").agg(F.count(F.lit(1)).alias("n"))
    span = counted.groupBy("o_custkey").agg(F.min("month_end").alias("first"), F.max("month_end").alias("last"))
    months = F.months_between("last", "first").cast("int") + F.lit(1)
    spine = span.select("o_custkey", F.explode(month_ends(F.col("first"), months)).alias("month_end"))
    return spine.join(counted, ["o_custkey", "month_end"], "left").select(
        "o_custkey", "month_end", F.coalesce("n", F.lit(0)).alias("n"),
        is_quarter_end(F.col("month_end")).cast("int").alias("quarter_end"), F.year("month_end").alias("year"),
    )


def array_to_json(spark, sf_dir):
    words = F.transform(F.split("p_name", " "), lambda w: F.when(w != "red", F.concat(w, F.lit(" «я»"))))
    numbers = F.array(F.col("p_partkey"), F.col("p_size").cast("bigint"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", json_array(words).alias("words"), json_array(numbers).alias("numbers"),
        json_array(F.slice(words, F.lit(1), F.col("p_size") % 2)).alias("maybe_empty"),
    )


def nested_json(spark, sf_dir):
    """Arrays inside arrays as JSON text."""
    words = F.transform(F.split("p_name", " "), lambda w: F.when(w != "red", F.split(w, "e")))
    deep = F.array(F.array(F.array("p_partkey", F.col("p_size").cast("bigint"))), F.array().cast("array<array<bigint>>"))
    return table(spark, sf_dir, "part").select("p_partkey", json_array(words).alias("words"), json_array(deep).alias("deep"))


def json_first_of_events(spark, sf_dir):
    items = F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit(", 7]"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), json_first(items).cast("bigint").alias("first_item")
    )


def prefix_extract(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", prefix_before(F.col("p_name"), " ").alias("first_word"), prefix_before(F.col("p_name"), " /").alias("none")
    )


def strip_keyword(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", strip_leading_word(F.col("p_name"), ["red", "blue", "hot", "small"]).alias("bare")
    )


def last_word(spark, sf_dir):
    name = F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return table(spark, sf_dir, "part").select("p_partkey", last_token(name, F.col("p_brand")).alias("tail"))


def part_name_share(spark, sf_dir):
    turn = F.col("p_partkey") % 3
    tail = F.when(turn == 0, " РАЗРАБОТЧИК").when(turn == 1, " рАзработчиК").otherwise(" разра6отчик")
    parts = table(spark, sf_dir, "part").withColumn("name", F.concat(F.col("p_name"), tail))
    hit = contains_pattern(F.col("name"), "^(red|BLUE).*разработчик")
    return parts.groupBy("p_type").agg(F.round(F.avg(hit.cast("double")), 9).alias("share"))


def half_even_counts(spark, sf_dir):
    """Half-even rounding and clamping on line quantities."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(half_even(F.col("l_quantity") * F.lit(0.5))).alias("halves"),
        F.sum(F.greatest(F.lit(0), F.least(F.lit(30), F.col("l_quantity").cast("bigint") - F.lit(5)))).alias("clamped"),
    )


# -- snapshot questions on raw tables ------------------------------------------------------


def monthly_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
        F.last_day(F.col("o_orderdate").cast("date")).alias("report_date"),
    )


def orders_by_month(spark, sf_dir):
    return snapshots.headcount_by_snapshot(monthly_orders(spark, sf_dir))


def orders_top_groups(spark, sf_dir):
    return snapshots.top_groups(monthly_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"], 10)


def orders_snapshot_diff(spark, sf_dir):
    return snapshots.snapshot_diff(monthly_orders(spark, sf_dir), "o_custkey")


def orders_gone(spark, sf_dir):
    """Orders of the first month whose customer has none in the last month."""
    rows = monthly_orders(spark, sf_dir)
    return snapshots.missing_from(snapshots.earliest_snapshot(rows), snapshots.latest_snapshot(rows), "o_custkey").select("o_orderkey", "o_custkey")


def orders_latest(spark, sf_dir):
    return snapshots.latest_snapshot(monthly_orders(spark, sf_dir))


def orders_earliest(spark, sf_dir):
    return snapshots.earliest_snapshot(monthly_orders(spark, sf_dir))


def part_word_popularity(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("words"), F.lit(1).alias("period"))
    return snapshots.skill_popularity(words, "words", 15, "period", "word")


# -- panel questions --------------------------------------------------------------------


def on_panel(question: Callable[..., DataFrame], *args, **named) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: question(stored_panel(spark, sf_dir), *args, **named)


def latest_members(spark, sf_dir):
    return snapshots.latest_snapshot(stored_panel(spark, sf_dir)).select("report_date", "employee_id", "grade_num")


def earliest_members(spark, sf_dir):
    return snapshots.earliest_snapshot(stored_panel(spark, sf_dir)).select("report_date", "employee_id", "grade_num")


def one_full_member(spark, sf_dir):
    members = snapshots.full_history(stored_panel(spark, sf_dir))
    return snapshots.random_entity(members, F.col("employee_id").cast("bigint"))


def one_history(spark, sf_dir):
    """The chosen employee's rows: one folder of the layout by member, found while the query runs."""
    rows = rows_of_member(panel_by_member(spark, sf_dir), one_full_member(spark, sf_dir))
    return rows.select(*snapshots.HISTORY_COLUMNS).orderBy("report_date")


def first_history(spark, sf_dir):
    return snapshots.lookup_history(rows_of_member(panel_by_member(spark, sf_dir), "10000001"), "10000001")


def point_lookup_layout(spark, sf_dir):
    """Rows of one employee, tribe, cluster and position per month, each a lookup on the clustered layout."""
    rows = clustered_panel(spark, sf_dir)
    known = stored_panel(spark, sf_dir)
    found = []
    for column in ACCESS_COLUMNS:
        value = F.lit("10000001") if column == "employee_id" else known.select(F.min(column)).scalar()
        hit = rows.where(F.col(column) == value)
        found.append(
            hit.groupBy(F.lit(column).alias("path"), F.col(column).cast("string").alias("value"), "report_date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("grade_num").alias("grades"))
        )
    return functools.reduce(DataFrame.unionByName, found)


def panel_bitmaps(spark, sf_dir):
    """The members of every month as stored bitmaps."""

    def build() -> str:
        path = staging_path(spark, "presence")
        presence_bitmaps(stored_panel(spark, sf_dir), "employee_id", "report_date").write.parquet(path)
        return path

    return spark.read.parquet(_once(spark, sf_dir, "presence", build))


def turnover_pairs(spark, sf_dir):
    return turnover_of_all_pairs(panel_bitmaps(spark, sf_dir))


def presence_counts(spark, sf_dir):
    return always_there(panel_bitmaps(spark, sf_dir))


def orders_turnover_pairs(spark, sf_dir):
    return turnover_of_all_pairs(presence_bitmaps(monthly_orders(spark, sf_dir), "o_custkey", "report_date"))


def it_share(spark, sf_dir):
    shares = snapshots.regex_share(stored_panel(spark, sf_dir))
    return shares.select(F.round("it_share", 9).alias("it_share"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_panel": scan_panel,
    "panel_roundtrip": panel_roundtrip,
    "appended_month": appended_month,
    "latest_stored_month": latest_stored_month,
    "flat_export": flat_export,
    "panel_rows": panel_rows,
    "latest_snapshot": latest_members,
    "earliest_snapshot": earliest_members,
    "orders_latest_snapshot": orders_latest,
    "orders_earliest_snapshot": orders_earliest,
    "headcount_by_snapshot": on_panel(snapshots.headcount_by_snapshot),
    "orders_by_month": orders_by_month,
    "org_headcount": on_panel(snapshots.org_headcount),
    "flat_org_headcount": flat_org_headcount,
    "flat_export_all": flat_table,
    "flat_skill_holders": flat_skill_holders,
    "flat_skill_popularity": flat_skill_popularity,
    "flat_top_groups": flat_top_groups,
    "exact_k_sample_nullable": exact_k_sample_nullable,
    "top_groups": on_panel(snapshots.top_groups),
    "orders_top_groups": orders_top_groups,
    "grade_profile": on_panel(snapshots.grade_profile),
    "skill_holders": on_panel(snapshots.skill_holders, "Python"),
    "skill_holders_none": on_panel(snapshots.skill_holders, "COBOL"),
    "skill_popularity": on_panel(snapshots.skill_popularity),
    "part_word_popularity": part_word_popularity,
    "snapshot_diff": on_panel(snapshots.snapshot_diff),
    "orders_snapshot_diff": orders_snapshot_diff,
    "orders_gone": orders_gone,
    "full_history": on_panel(snapshots.full_history),
    "random_entity": one_full_member,
    "entity_history": one_history,
    "entity_lookup": first_history,
    "point_lookup_layout": point_lookup_layout,
    "turnover_pairs": turnover_pairs,
    "orders_turnover_pairs": orders_turnover_pairs,
    "presence_counts": presence_counts,
    "regex_share": it_share,
    "part_regex_share": part_name_share,
    "panel_roster": panel_roster,
    "roster_turnover": roster_turnover,
    "tenure": tenure,
    "raise_counter": raise_counter,
    "quarter_refresh": quarter_refresh,
    "unit_moves": unit_moves,
    "grade_growth": grade_growth,
    "seeded_draw": seeded_draw,
    "base_attributes": base_attributes,
    "weighted_category": weighted_category,
    "person_names": person_names,
    "contacts": contacts,
    "skill_sets": skill_sets,
    "children_arrays": children_arrays,
    "goal_shortfall": goal_shortfall,
    "org_tree": org_units,
    "org_paths": org_paths,
    "block_shares": block_shares,
    "greedy_cover": cover,
    "agile_structure": agile_structure,
    "templated_labels": templated_labels,
    "agile_assignment": agile_assignment,
    "weighted_assignment": weighted_assignment,
    "alias_assignment": alias_assignment,
    "subtree_headcount": subtree_headcount,
    "deep_subtree_headcount": deep_subtree_headcount,
    "unit_leaders": led_units,
    "agile_leaders": led_groups,
    "leader_columns": leader_columns,
    "random_peers": peers,
    "part_picks": part_picks,
    "exact_k_sample": exact_k_sample,
    "entity_sample": entity_sample,
    "price_rank": price_rank,
    "month_spine": month_spine_of_orders,
    "array_to_json": array_to_json,
    "nested_array_to_json": nested_json,
    "json_first": json_first_of_events,
    "prefix_extract": prefix_extract,
    "strip_keyword": strip_keyword,
    "last_token": last_word,
    "half_even": half_even_counts,
}
