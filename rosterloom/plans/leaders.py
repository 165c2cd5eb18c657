"""Leaders per month and unit, tribe or cluster: the manager with the smallest number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.operators.lookups import with_ancestors
from rosterloom.sources.staging import materialize

NO_LEADER = 0


def unit_leaders(managers: DataFrame, month: str = "month_no", member: str = "emp_no", path: str = "path") -> DataFrame:
    """(month, uid, leader) for every unit with a manager in its subtree."""
    return (
        with_ancestors(managers.select(month, member, path), path, "uid")
        .groupBy(month, "uid")
        .agg(F.min(member).alias("leader"))
    )


def agile_leaders(
    managers: DataFrame, code: str, month: str = "month_no", member: str = "emp_no"
) -> DataFrame:
    """(month, code, leader) over managers whose unit has an agile row."""
    return managers.where(F.col(code).isNotNull()).groupBy(month, code).agg(F.min(member).alias("leader"))


def leaf_leaders(managers: DataFrame, leaves: DataFrame, month: str = "month_no", member: str = "emp_no") -> DataFrame:
    """One row per month and leaf with all of its leaders, 0 where there is none.

    ``managers`` carries (month, member, leaf_uid).  One pass shrinks them to a row per month
    and leaf; that table is kept, and what follows is of the tree's size.
    """
    per_leaf = materialize(managers.groupBy(month, "leaf_uid").agg(F.min(member).alias(member)))
    placed = per_leaf.join(leaves.select("leaf_uid", "path", "tribe_code", "cluster_code"), "leaf_uid")
    seats = leaves.select("leaf_uid", "path", "tribe_code", "cluster_code")
    units = unit_leaders(placed, month, member)
    steps = seats.select("leaf_uid", F.posexplode("path").alias("_depth", "uid"))
    level = [
        F.max(F.when(F.col("_depth") == depth, F.col("leader"))).alias(f"level{depth + 1}_leader")
        for depth in range(3)
    ]
    by_level = steps.where(F.col("_depth") < 3).join(units, "uid").groupBy(month, "leaf_uid").agg(*level)
    for code in ("tribe_code", "cluster_code"):
        led = agile_leaders(placed, code, month, member).withColumnRenamed("leader", code.replace("_code", "_leader"))
        by_seat = seats.select("leaf_uid", code).join(led, code).drop(code)
        by_level = by_level.join(by_seat, [month, "leaf_uid"], "left")
    return by_level


def leader_or_none(leader: F.Column) -> F.Column:
    return F.coalesce(leader.cast("bigint"), F.lit(NO_LEADER).cast("bigint"))
