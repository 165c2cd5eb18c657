"""Organisation tree and agile structure as dimension tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.functions import pools
from rosterloom.functions.draws import (
    DEFAULT_SEED, PICK_RANGE, draw, literal_array, pick, shuffle_marks, uniform_int,
)
from rosterloom.functions.scores import share_of
from rosterloom.functions.text import by_key, last_token, path_text
from rosterloom.operators.ranking import draw_bucket, even_bucket, greedy_cover, totals_before
from rosterloom.operators.sides import spread
from rosterloom.operators.windows import chunk_no, share_in_group
from rosterloom.sources.staging import materialize

# First numbers of the code sequences, children per level, covered share of leaves.
FIRST_UID = 1001
FIRST_TRIBE, FIRST_CLUSTER, FIRST_TEAM = 5001, 6001, 7001
L2_RANGE, L3_RANGE, L4_RANGE = (3, 5), (2, 4), (2, 5)
LEAVES_PER_BLOCK = L2_RANGE[1] * L3_RANGE[1] * L4_RANGE[1]
COVERAGE = (80, 100)
NODE = ["block_no", "i2", "i3", "i4"]
#: Blocks whose units one task lays out and orders, at most 126 units each.
BLOCKS_PER_TASK = 2_000


@dataclass(frozen=True)
class Organisation:
    """Dimension tables, with a bound on the number of leaves if one is known."""

    units: DataFrame
    leaves: DataFrame
    teams: DataFrame
    max_leaves: int | None


def default_blocks(spark: SparkSession) -> DataFrame:
    """The five blocks: block_no, name, is_it, share."""
    number = F.col("id").cast("int")
    return spark.range(len(pools.BLOCK_NAMES)).select(
        F.col("id").alias("block_no"),
        by_key(number, dict(enumerate(pools.BLOCK_NAMES))).alias("name"),
        by_key(number, dict(enumerate(pools.BLOCK_IS_IT))).alias("is_it"),
        by_key(number, dict(enumerate(pools.BLOCK_SHARES))).cast("bigint").alias("share"),
    )


def unit_rows(blocks: DataFrame, seed: int = DEFAULT_SEED, extra: Sequence[str] = ()) -> DataFrame:
    """All units under the blocks, numbered by their place in each level; columns ``extra`` of a block go to all of its units.

    A level is laid out row by row, each parent ahead of its children, so the units of a block never leave the block's partition.
    """
    out = ["block_no", "i2", "i3", "i4", "level", "name", "is_it", "share", *extra]

    def expand(units: DataFrame, level: int, span: tuple[int, int], it_pool, bank_pool, suffix=None) -> DataFrame:
        """All rows so far and the children of the last level: a drawn number of them, named by distinct picks from a pool."""
        parent = F.col("level") == level - 1
        count = uniform_int(draw(f"l{level}_count", *NODE, seed=seed), *span).cast("int")
        order = shuffle_marks(f"l{level}_names", len(it_pool), *NODE, seed=seed)
        if len(it_pool) != len(bank_pool):
            bank_order = shuffle_marks(f"l{level}_names", len(bank_pool), *NODE, seed=seed)
            order = F.when(F.col("is_it"), order).otherwise(bank_order)
        pool = literal_array(it_pool)
        if it_pool is not bank_pool:
            pool = F.when(F.col("is_it"), pool).otherwise(literal_array(bank_pool))
        chosen = (F.get("_order", F.col("_nth") - F.lit(1)) % F.lit(256)).cast("int")
        child = F.col("_nth") > 0
        grown = (
            units.select("*", F.when(parent, order).alias("_order"), F.explode(F.sequence(F.lit(0), F.when(parent, count).otherwise(F.lit(0)))).alias("_nth"))
            .withColumns({
                "name": F.when(child, F.get(pool, chosen)).otherwise(F.col("name")),
                "level": F.when(child, F.lit(level)).otherwise(F.col("level")),
                f"i{level}": F.when(child, F.col("_nth")).otherwise(F.col(f"i{level}")),
            })
        )
        if suffix is not None:
            grown = grown.withColumn("name", F.when(child, suffix(F.col("name"))).otherwise(F.col("name")))
        return grown.select(*out)

    l1 = blocks.select(
        F.col("block_no").cast("bigint").alias("block_no"), *[F.lit(0).alias(c) for c in ("i2", "i3", "i4")], F.lit(1).alias("level"), "name", "is_it",
        F.col("share").cast("bigint").alias("share"), *extra,
    )
    tag = pick(draw("l3_tag", *NODE, seed=seed), pools.L3_TAGS)
    number = uniform_int(draw("l4_number", *NODE, seed=seed), 1, 99).cast("string")
    l2 = expand(l1, 2, L2_RANGE, pools.L2_IT, pools.L2_BANK)
    l3 = expand(l2, 3, L3_RANGE, pools.L3_NAMES, pools.L3_NAMES, lambda name: F.concat_ws(" ", name, tag))
    return expand(l3, 4, L4_RANGE, pools.L4_NAMES, pools.L4_NAMES, lambda name: F.concat_ws("-", name, number))


def org_tree(blocks: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Units with ids in depth-first order, their path, full name and share of headcount.

    uid, parent_uid, level, name, is_it, raw_weight, weight, path, full_name, pick_low, pick_high
    """
    # Ids run through the blocks one after the other: count per block, then one row number inside each.
    blocks = blocks.withColumn("block_no", F.col("block_no").cast("bigint"))
    total_blocks = blocks.count()
    sizes = unit_rows(spread(blocks, "block_no", rows=total_blocks, rows_per_task=BLOCKS_PER_TASK), seed).groupBy("block_no").agg(
        F.count(F.lit(1)).alias("_units"), F.first("share").alias("_share")
    )
    total_share = blocks.select(F.sum(F.col("share").cast("bigint"))).scalar()
    starts = totals_before(
        sizes, ["block_no"], even_bucket(blocks, "block_no"),
        {"_uid_start": F.col("_units"), "_share_before": F.col("_share")},
    ).select(
        "block_no",
        "_uid_start",
        share_of(F.col("_share_before"), total_share, PICK_RANGE).alias("_low"),
        share_of(F.col("_share_before") + F.col("_share"), total_share, PICK_RANGE).alias("_high"),
        (F.col("_share").cast("double") / total_share.cast("double")).alias("_part"),
    )
    # Starts meet the blocks, a row each; no estimate of the far more numerous units decides on a broadcast.
    started = spread(blocks.join(starts.hint("merge"), "block_no"), "block_no", rows=total_blocks, rows_per_task=BLOCKS_PER_TASK)
    units = unit_rows(started, seed, ["_uid_start", "_low", "_high", "_part"])
    block = Window.partitionBy("block_no").orderBy("i2", "i3", "i4")
    l2 = Window.partitionBy("block_no", "i2").orderBy("i3", "i4")
    l3 = Window.partitionBy("block_no", "i2", "i3").orderBy("i4")
    numbered = units.withColumn(
        "uid", F.lit(FIRST_UID - 1).cast("bigint") + F.col("_uid_start") + F.row_number().over(block)
    )
    # The first row of a subtree, in depth-first order, is its root.
    traced = numbered.select(
        "*",
        *[F.first(c).over(w).alias(f"_{c}{n}") for n, w in ((1, block), (2, l2), (3, l3)) for c in ("uid", "name")],
        F.when(
            F.col("level") == 4, uniform_int(draw("leaf_weight", *NODE, seed=seed), 600_000, 1_600_000)
        ).alias("raw_weight"),
    )
    depth = F.col("level")
    path = F.slice(F.array("_uid1", "_uid2", "_uid3", "uid"), F.lit(1), depth)
    names = F.slice(F.array("_name1", "_name2", "_name3", "name"), F.lit(1), depth)
    up_to_here = Window.partitionBy("block_no").orderBy("i2", "i3", "i4").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("raw_weight").over(up_to_here), F.lit(0))
    all_weight = F.sum("raw_weight").over(Window.partitionBy("block_no"))
    span = F.col("_high") - F.col("_low")
    return traced.select(
        "uid",
        F.get(path, depth - F.lit(2)).alias("parent_uid"),
        "level",
        "name",
        "is_it",
        "raw_weight",
        share_in_group(F.col("raw_weight"), ["block_no"], F.col("_part")).alias("weight"),
        path.alias("path"),
        path_text(names).alias("full_name"),
        F.when(depth == 4, F.col("_low") + share_of(before, all_weight, span)).alias("pick_low"),
        F.when(
            depth == 4, F.col("_low") + share_of(before + F.col("raw_weight"), all_weight, span)
        ).alias("pick_high"),
    )


def agile_teams(units: DataFrame, seed: int = DEFAULT_SEED, coverage: tuple[int, int] = COVERAGE) -> DataFrame:
    """Tribe, cluster and team of each covered leaf; leaves beyond the coverage have no row.

    leaf_uid, is_it, tribe_name, tribe_code, cluster_name, cluster_code, team_name, team_code
    """
    leaves = units.where(F.col("level") == 4).select(
        F.col("uid").alias("leaf_uid"), "is_it", "name", F.get("path", 1).alias("l2_uid"),
        (F.col("pick_high") - F.col("pick_low")).alias("headcount_weight"),
        draw("cover_order", "uid", seed=seed).alias("cover_u"),
    )
    covered = greedy_cover(leaves, "headcount_weight", "cover_u", "leaf_uid", coverage)
    placed = covered.withColumn("cluster_u", draw("cluster_order", "leaf_uid", seed=seed)).select(
        "*",
        chunk_no(
            ["l2_uid"], ["cluster_u", "leaf_uid"], uniform_int(draw("clusters", "l2_uid", seed=seed), 1, 3)
        ).alias("_chunk"),
        F.row_number().over(Window.partitionBy("l2_uid").orderBy("cluster_u", "leaf_uid")).alias("_place"),
    )
    # Codes run on from tribe to tribe, in the order in which tribes first appear in the cover.
    tribes = totals_before(
        placed.groupBy("l2_uid").agg(
            F.min("cover_u").alias("_first_u"),
            F.count(F.lit(1)).alias("_leaves"),
            (F.max("_chunk") + F.lit(1)).alias("_clusters"),
        ),
        ["_first_u", "l2_uid"],
        draw_bucket(F.col("_first_u")),
        {"_tribes_before": F.lit(1), "_clusters_before": F.col("_clusters"), "_teams_before": F.col("_leaves")},
    ).select("l2_uid", "_tribes_before", "_clusters_before", "_teams_before")
    coded = placed.join(tribes, "l2_uid").select(
        "leaf_uid", "is_it", "name",
        (F.lit(FIRST_TRIBE) + F.col("_tribes_before")).cast("int").alias("tribe_code"),
        (F.lit(FIRST_CLUSTER) + F.col("_clusters_before") + F.col("_chunk")).cast("int").alias("cluster_code"),
        (F.lit(FIRST_TEAM - 1) + F.col("_teams_before") + F.col("_place")).cast("int").alias("team_code"),
    )
    return coded.select(
        "leaf_uid", "is_it",
        tribe_name(F.col("is_it"), F.col("tribe_code"), seed).alias("tribe_name"), "tribe_code",
        cluster_name(F.col("is_it"), F.col("cluster_code"), seed).alias("cluster_name"), "cluster_code",
        team_name(F.col("is_it"), F.col("team_code"), F.col("name"), seed).alias("team_name"), "team_code",
    )


def _themed(is_it, u, it_pool, bank_pool):
    return F.when(is_it, pick(u, it_pool)).otherwise(pick(u, bank_pool))


def tribe_name(is_it, code, seed: int = DEFAULT_SEED):
    """Three styles of tribe names: numbered by code, marked behind, or marked ahead."""
    style = draw("tribe_style", code, seed=seed) % F.lit(3)
    theme = _themed(is_it, draw("tribe_theme", code, seed=seed), pools.TRIBE_THEMES_IT, pools.TRIBE_THEMES_BANK)
    mark = pick(draw("tribe_mark", code, seed=seed), pools.MARKS)
    return (
        F.when(style == 0, F.format_string("Tribe %d: %s", code, theme))
        .when(style == 1, F.format_string("%s (%s)", theme, mark))
        .otherwise(F.format_string("%s of %s", mark, theme))
    )


def cluster_name(is_it, code, seed: int = DEFAULT_SEED):
    """Two styles of cluster names: numbered by code, or one of nine parts of a topic."""
    style = draw("cluster_style", code, seed=seed) % F.lit(2)
    topic = _themed(is_it, draw("cluster_theme", code, seed=seed), pools.CLUSTER_THEMES_IT, pools.CLUSTER_THEMES_BANK)
    part = F.pmod(code, F.lit(9)) + F.lit(1)
    return F.when(style == 0, F.format_string("Cluster %d: %s", code, topic)).otherwise(
        F.format_string("%s, part %d", topic, part)
    )


def team_name(is_it, code, leaf_name, seed: int = DEFAULT_SEED):
    """Four styles of team names; one of them takes the last word of the unit name."""
    style = draw("team_style", code, seed=seed) % F.lit(4)
    nick = pick(draw("team_nick", code, seed=seed), pools.TEAM_NICKS)
    suffix = _themed(is_it, draw("team_suffix", code, seed=seed), pools.TEAM_SUFFIXES_IT, pools.TEAM_SUFFIXES_BANK)
    return (
        F.when(style == 0, nick)
        .when(style == 1, F.format_string("%s %s", nick, suffix))
        .when(style == 2, F.format_string("%s from %s", nick, last_token(leaf_name, nick)))
        .otherwise(F.format_string("Team %d: %s", code, nick))
    )


def leaf_table(units: DataFrame, teams: DataFrame) -> DataFrame:
    """Leaves with their pick interval, path, names and, where covered, agile row."""
    leaves = units.where(F.col("level") == 4).select(
        F.col("uid").alias("leaf_uid"), "name", "level", "is_it", "path", "full_name", "pick_low", "pick_high"
    )
    return leaves.join(teams.drop("is_it"), "leaf_uid", "left")


def build_organisation(
    blocks: DataFrame, seed: int = DEFAULT_SEED, max_blocks: int | None = None, coverage: tuple[int, int] = COVERAGE
) -> Organisation:
    """All dimension tables, each computed once.

    ``max_blocks`` is a known bound on the number of blocks, if there is one.
    """
    units = materialize(org_tree(blocks, seed))
    teams = materialize(agile_teams(units, seed, coverage))
    bound = None if max_blocks is None else max_blocks * LEAVES_PER_BLOCK
    return Organisation(units, materialize(leaf_table(units, teams)), teams, bound)
