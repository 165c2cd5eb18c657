"""Who is there in which period, as bitmaps: sets of members that are stored once and then combined.

A member is a whole number, best dense.  A bitmap covers 32,768 numbers, so a period has a row per such block instead of a row
per member.  Questions about any periods are bit operations on a few small rows and read no panel again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "block"


def presence_bitmaps(df: DataFrame, member: str, period: str) -> DataFrame:
    """(period, block, members): the distinct members of each period; rows without member or period are left out."""
    number = F.col(member).cast("bigint")
    return (
        df.where(F.col(member).isNotNull() & F.col(period).isNotNull())
        .groupBy(F.col(period).alias("period"), F.bitmap_bucket_number(number).alias(BLOCK))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("members"))
    )


def members_by_period(bitmaps: DataFrame) -> DataFrame:
    """(period, n): distinct members."""
    return bitmaps.groupBy("period").agg(F.sum(F.bitmap_count("members")).alias("n"))


def turnover_of_all_pairs(bitmaps: DataFrame) -> DataFrame:
    """(first, last, at_start, at_end, left_company, hired) for every pair of periods, the earlier one first.

    Bitmaps of two periods meet on their block; what both hold is the bitwise and.
    """
    sizes = members_by_period(bitmaps)
    a = bitmaps.select(F.col("period").alias("first"), BLOCK, F.col("members").alias("_a"))
    b = bitmaps.select(F.col("period").alias("last"), BLOCK, F.col("members").alias("_b"))
    met = a.join(b, BLOCK).where(F.col("first") < F.col("last")).select("first", "last", BLOCK, F.explode(F.array("_a", "_b")).alias("_one"))
    stayed = (
        met.groupBy("first", "last", BLOCK)
        .agg(F.bitmap_count(F.bitmap_and_agg("_one")).alias("_both"))
        .groupBy("first", "last")
        .agg(F.sum("_both").alias("_both"))
    )
    starts, ends = sizes.select(F.col("period").alias("first"), F.col("n").alias("at_start")), sizes.select(F.col("period").alias("last"), F.col("n").alias("at_end"))
    both = F.coalesce("_both", F.lit(0))
    return (
        starts.join(ends, F.col("first") < F.col("last"))  # a row per pair of periods, as in the result
        .join(stayed, ["first", "last"], "left")
        .select("first", "last", "at_start", "at_end", (F.col("at_start") - both).alias("left_company"), (F.col("at_end") - both).alias("hired"))
    )


def always_there(bitmaps: DataFrame) -> DataFrame:
    """(n, ever): members of all periods, and members of any."""
    periods = bitmaps.select(F.count_distinct("period")).scalar()
    blocks = bitmaps.groupBy(BLOCK).agg(
        F.bitmap_count(F.bitmap_and_agg("members")).alias("_all"), F.bitmap_count(F.bitmap_or_agg("members")).alias("_any"), F.count(F.lit(1)).alias("_n")
    )
    return blocks.agg(
        F.coalesce(F.sum(F.when(F.col("_n") == periods, F.col("_all"))), F.lit(0)).alias("n"), F.coalesce(F.sum("_any"), F.lit(0)).alias("ever")
    )
