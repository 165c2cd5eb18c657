"""Weighted picks from a table through an alias table: two draws and one equi join, whatever the weights.

Each of n options gets a slot of the same width.  A light option fills a part of its slot, and one heavy option, its alias,
the rest.  Who fills whose slot follows from running totals alone: laid end to end, what the light ones lack covers the same
line as what the heavy ones have too much, and a light one is filled by the heavy one that covers its start.  A heavy
one that is drawn on beyond its surplus is filled in turn by the next.  So the table comes from prefix sums and "first
after" look-ups over ranges of that line; no step walks through the options one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.draws import PICK_BITS
from rosterloom.functions.scores import whole_div
from rosterloom.operators.ranking import even_bucket, totals_before, with_rank
from rosterloom.operators.sides import bounded_or_merged
from rosterloom.sources.staging import materialize

WIDE = "decimal(38,0)"
RANGES = 256


def first_after(df: DataFrame, order: Sequence[str], bucket: Column, value: Column, name: str) -> DataFrame:
    """Adds the first value that is not null in a later row of the order; ``bucket`` never falls along the order."""
    ranged = df.withColumn("_bucket", bucket).withColumn("_value", value)
    # Backwards, so that the frame grows row by row; one that shrinks would be gone through again for every row.
    inside = Window.partitionBy("_bucket").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    heads = ranged.where(F.col("_value").isNotNull()).groupBy("_bucket").agg(F.min_by("_value", F.struct(*order)).alias("_head"))
    buckets = ranged.select("_bucket").distinct().join(heads, "_bucket", "left")
    across = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)  # a row per range
    later = buckets.select("_bucket", F.first("_head", ignorenulls=True).over(across).alias("_later"))
    found = ranged.withColumn("_own", F.last("_value", ignorenulls=True).over(inside)).join(later, "_bucket")
    return found.select(*df.columns, F.coalesce("_own", "_later").alias(name))


def alias_table(options: DataFrame, key: str, weight: str) -> tuple[DataFrame, int]:
    """(slot, key, alias, cut) and the number of slots; key is a unique BIGINT, weights are whole numbers.

    Options without a positive weight get no slot.  A draw below ``cut`` (of 2^62) takes ``key``, any other ``alias``.
    """
    used = options.where(F.col(weight) > 0).select(F.col(key).cast("bigint").alias("key"), F.col(weight).cast("bigint").alias("w"))
    numbered = materialize(with_rank(used, "slot", ["key"], even_bucket(used, "key", RANGES)))
    n, total = numbered.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("w").cast(WIDE)), F.lit(0))).first()
    if not n:
        return numbered.select("slot", "key", F.col("key").alias("alias"), F.lit(0).cast("bigint").alias("cut")), 0
    total = int(total)
    whole = F.lit(str(total)).cast(WIDE)
    over = F.col("w").cast(WIDE) * F.lit(n) - whole  # negative: what a light option lacks
    parts = numbered.select("slot", "key", over.cast(WIDE).alias("over"))
    width = max(1, -(-n // RANGES))
    lacks, spare = F.greatest(-F.col("over"), F.lit(0)).cast(WIDE), F.greatest(F.col("over"), F.lit(0)).cast(WIDE)
    placed = totals_before(parts, ["slot"], whole_div(F.col("slot"), F.lit(width)), {"_lacking": lacks, "_spare": spare})
    line = materialize(placed.select("slot", "key", "over", *[F.col(c).cast(WIDE).alias(c) for c in ("_lacking", "_spare")]))
    light = F.col("over") < 0
    reach = int(line.agg(F.coalesce(F.sum(F.when(light, -F.col("over"))), F.lit(0))).first()[0])
    stretch = F.lit(str(max(1, -(-reach // RANGES)))).cast(WIDE)

    def after(at: Column, turn: Column, value: Column, name: str) -> DataFrame:
        events = line.select("*", at.cast(WIDE).alias("_at"), turn.alias("_turn"))
        return first_after(events, ["_at", "_turn", "slot"], whole_div(F.col("_at"), stretch), value, name)

    end = F.col("_spare") + F.col("over")  # of a heavy option's surplus
    # A light option's start, and the first surplus that ends beyond it; ends come before starts at the same place.
    heavy_keys = F.when(~light & (F.col("over") > 0), F.col("key"))
    filled = after(F.when(light, F.col("_lacking")).otherwise(end), F.when(light, F.lit(1)).otherwise(F.lit(0)), heavy_keys, "alias").where(light)
    # A heavy option's end, and where the light option that reaches it ends; and the next heavy one.
    ends = F.when(light, F.col("_lacking") - F.col("over"))
    drawn = after(F.when(light, ends).otherwise(end), F.when(light, F.lit(1)).otherwise(F.lit(0)), ends, "_until").where(~light)
    drawn = first_after(drawn, ["slot"], whole_div(F.col("slot"), F.lit(width)), heavy_keys, "alias").withColumn(
        "_excess", F.when(F.col("over") > 0, F.coalesce(F.col("_until") - end, F.lit(0))).otherwise(F.lit(0)).cast(WIDE)
    )
    kept = filled.select("slot", "key", "alias", (whole + F.col("over")).cast(WIDE).alias("_kept")).unionByName(
        drawn.select("slot", "key", "alias", (whole - F.col("_excess")).cast(WIDE).alias("_kept"))
    )
    # kept * 2^62 div total without leaving 38 digits: the remainder is scaled in two steps
    half = F.lit(1 << (PICK_BITS // 2)).cast("decimal(10,0)")
    high = whole_div(F.col("_kept").cast("decimal(27,0)") * half, whole)
    rest = F.col("_kept") * half - high.cast("decimal(19,0)") * whole
    cut = high * F.lit(1 << (PICK_BITS // 2)) + whole_div(rest.cast("decimal(27,0)") * half, whole)
    return kept.select("slot", "key", F.coalesce("alias", "key").alias("alias"), cut.cast("bigint").alias("cut")), n


def alias_pick(df: DataFrame, slot_draw: Column, cut_draw: Column, table: DataFrame, n: int, name: str) -> DataFrame:
    """Adds the picked key; ``slot_draw`` is a wide draw, ``cut_draw`` one of 62 bits.  Slots are hit evenly, so no join key is hot."""
    if not n:
        raise ValueError("nothing to pick from")
    slots = table.select("slot", F.col("key").alias("_key"), F.col("alias").alias("_alias"), F.col("cut").alias("_cut"))
    drawn = df.withColumn("slot", F.pmod(slot_draw, F.lit(n).cast("bigint"))).withColumn("_u", cut_draw)
    met = drawn.join(bounded_or_merged(slots, n), "slot")
    return met.select(*[drawn[c] for c in df.columns], F.when(F.col("_u") < F.col("_cut"), F.col("_key")).otherwise(F.col("_alias")).alias(name))
