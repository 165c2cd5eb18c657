"""Questions about a table of snapshots: one row per member and period.

Column names are parameters, so each function runs on the panel and on any other such table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions import pools
from rosterloom.functions.draws import DEFAULT_SEED, draw
from rosterloom.functions.scores import letter_score
from rosterloom.functions.text import contains_pattern, json_first, prefix_before
from rosterloom.sources.schema import MEMBER, PERIOD


def latest_snapshot(df: DataFrame, period: str = PERIOD) -> DataFrame:
    """Rows of the last period; on a table partitioned by the period only its folder is read."""
    return df.where(F.col(period) == df.select(F.max(period)).scalar())


def earliest_snapshot(df: DataFrame, period: str = PERIOD) -> DataFrame:
    return df.where(F.col(period) == df.select(F.min(period)).scalar())


def headcount_by_snapshot(df: DataFrame, period: str = PERIOD) -> DataFrame:
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("headcount")).orderBy(period)


def org_headcount(
    df: DataFrame, path: str = "unit_id_tree", full_name: str = "full_oshs_name", period: str = PERIOD
) -> DataFrame:
    """Headcount of the top units in the last period; takes paths as arrays or as JSON text."""
    native = dict(df.dtypes)[path].startswith("array")
    top = F.get(F.col(path), F.lit(0)) if native else json_first(F.col(path)).cast("bigint")
    return (
        latest_snapshot(df, period)
        .select(top.alias("l1_uid"), prefix_before(F.col(full_name), " /").alias("l1_name"))
        .groupBy("l1_uid", "l1_name")
        .agg(F.count(F.lit(1)).alias("headcount"))
        .orderBy(F.desc("headcount"), "l1_uid")
    )


def top_groups(
    df: DataFrame, keys: Sequence[str] = ("tribe_name", "tribe_code"), k: int = 10, period: str = PERIOD
) -> DataFrame:
    """The k largest groups of the last period whose first key is known; ties go to the smaller key."""
    return (
        latest_snapshot(df, period)
        .where(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("headcount"))
        .orderBy(F.desc("headcount"), *reversed(keys))
        .limit(k)
    )


def grade_profile(
    df: DataFrame,
    grade: str = "grade_num",
    letter: str = "fp_res",
    tenure: str = "sber_los_cnt_days",
    period: str = PERIOD,
) -> DataFrame:
    """Per grade in the last period: members, mean score (2 digits), mean tenure in years (1 digit)."""
    return (
        latest_snapshot(df, period)
        .groupBy(grade)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(letter_score(F.col(letter))), 2).alias("avg_fp_res"),
            F.round(F.avg(tenure) / F.lit(365.0), 1).alias("avg_tenure_years"),
        )
        .orderBy(grade)
    )


def _items(df: DataFrame, items: str) -> Column:
    """The array column, also where it is kept as JSON text."""
    if dict(df.dtypes)[items].startswith("array"):
        return F.col(items)
    return F.from_json(F.col(items), "array<string>")


def skill_holders(
    df: DataFrame,
    skill: str,
    items: str = "all_skills",
    member: str = MEMBER,
    letter: str = "fp_res",
    period: str = PERIOD,
    name: str = "python_users",
) -> DataFrame:
    """Members with a skill in the last period and their mean score; (0, NULL) if nobody has it.

    Rows without the skill are dropped before the array is unfolded.
    """
    held = latest_snapshot(df, period).select(member, letter, _items(df, items).alias("_items"))
    return (
        held.where(F.array_contains("_items", skill))
        .select(member, letter, F.explode("_items").alias("_item"))
        .where(F.col("_item") == skill)
        .agg(
            F.count_distinct(member).alias(name),
            F.round(F.avg(letter_score(F.col(letter))), 2).alias("avg_fp_res"),
        )
    )


def skill_popularity(
    df: DataFrame, items: str = "all_skills", k: int = 15, period: str = PERIOD, name: str = "skill"
) -> DataFrame:
    """The k most frequent array items of the last period; ties go to the smaller item."""
    return (
        latest_snapshot(df, period)
        .select(F.explode(_items(df, items)).alias(name))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), name)
        .limit(k)
    )


def snapshot_diff(df: DataFrame, member: str = MEMBER, period: str = PERIOD) -> DataFrame:
    """Rows at the first and last period, and rows whose member is missing at the other one.

    One pass over the two periods with partial sums per member, instead of two anti joins.
    """
    bounds = df.select(F.struct(F.min(period).alias("first"), F.max(period).alias("last"))).scalar()
    first, last = bounds["first"], bounds["last"]
    per_member = (
        df.where((F.col(period) == first) | (F.col(period) == last))
        .select(member, (F.col(period) == first).cast("bigint").alias("_at_first"), (F.col(period) == last).cast("bigint").alias("_at_last"))
        .groupBy(member)
        .agg(F.sum("_at_first").alias("_first"), F.sum("_at_last").alias("_last"))
    )

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")

    return per_member.agg(
        total(F.col("_first")).alias("at_start"),
        total(F.col("_last")).alias("at_end"),
        total(F.when(F.col("_last") == 0, F.col("_first"))).alias("left_company"),
        total(F.when(F.col("_first") == 0, F.col("_last"))).alias("hired"),
    )


def missing_from(left: DataFrame, right: DataFrame, member: str = MEMBER) -> DataFrame:
    """Rows of ``left`` whose member does not occur in ``right``."""
    return left.join(right.select(member).where(F.col(member).isNotNull()), member, "left_anti")


def full_history(df: DataFrame, member: str = MEMBER, period: str = PERIOD) -> DataFrame:
    """Members with as many rows as there are periods."""
    periods = df.select(F.count_distinct(period)).scalar()
    return (
        df.groupBy(member).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") == periods).select(member)
    )


def random_entity(members: DataFrame, key: Column, member: str = MEMBER, seed: int = DEFAULT_SEED) -> DataFrame:
    """One member by a seeded draw on a numeric key; a top-1, not a sort."""
    return (
        members.withColumn("_u", draw("random_entity", key, seed=seed)).orderBy("_u", member).limit(1).select(member)
    )


HISTORY_COLUMNS = (
    "report_date", "position_name", "grade_num", "sber_los_cnt_days", "tribe_name", "team_name", "fp_res", "fp_comp",
)


def entity_history(
    df: DataFrame,
    chosen: DataFrame,
    columns: Sequence[str] = HISTORY_COLUMNS,
    member: str = MEMBER,
    period: str = PERIOD,
) -> DataFrame:
    """All rows of the one member in ``chosen`` in period order, within one plan."""
    one = F.broadcast(chosen.limit(1))
    return df.join(one, member, "left_semi").select(*columns).orderBy(period)


def lookup_history(
    df: DataFrame,
    value: object,
    columns: Sequence[str] = HISTORY_COLUMNS,
    member: str = MEMBER,
    period: str = PERIOD,
) -> DataFrame:
    """History of a known member; the value is a bound parameter of the SQL text."""
    wanted = ", ".join(f"`{c}`" for c in columns)
    return df.sparkSession.sql(
        f"SELECT {wanted} FROM {{rows}} WHERE `{member}` = :value ORDER BY `{period}`",
        args={"value": value},
        rows=df,
    )


def regex_share(
    df: DataFrame,
    column: str = "position_name",
    pattern: str = pools.IT_TITLE_PATTERN,
    period: str | None = PERIOD,
    name: str = "it_share",
) -> DataFrame:
    """Share of rows whose text matches, in the first period."""
    rows = df if period is None else earliest_snapshot(df, period)
    return rows.agg(F.avg(contains_pattern(F.col(column), pattern).cast("double")).alias(name))
