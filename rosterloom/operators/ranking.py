"""Order-based operators that never sort a whole group in one task.

Each of them splits the order into ranges (``bucket``, a column that never falls
along the order), adds up the ranges first, and orders only inside a range.  With
a draw as the order the ranges are equally full whatever the data looks like; for any other number
:func:`even_bucket` takes the ranges from a sketch of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.draws import DRAW_BITS, literal_array
from rosterloom.operators.sides import broadcast_within, dimension_lookup, null_safe_join

BUCKET_BITS = 12
RANGES = 1 << 10
#: Rows of a group that one task may order when a sample's limit is looked for.
CANDIDATE_ROWS = 200_000


def draw_bucket(u: Column, bits: int = BUCKET_BITS) -> Column:
    """Top bits of a draw."""
    return F.shiftright(u, DRAW_BITS - bits)


def totals_before(
    df: DataFrame,
    order: Sequence[str],
    bucket: Column,
    values: Mapping[str, Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds, for each name in ``values``, the total of its column over all earlier rows.

    ``order`` must be total inside ``within``.  One shuffle of ``df``, on
    (within, bucket); the range totals are partial aggregates.
    """
    keys = [*within, "_bucket"]
    ranged = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = (
        Window.partitionBy(*(within or [F.lit(0)]))
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = ranged.groupBy(*keys).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    starts = sums.select(
        *keys, *[F.coalesce(F.sum(f"_sum_{n}").over(across), F.lit(0)).alias(f"_start_{n}") for n in values]
    )
    local = ranged.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_local_{n}") for n, v in values.items()]
    )
    return null_safe_join(local, starts, keys).select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_start_{n}") + F.col(f"_local_{n}")).alias(n) for n in values],
    )


def with_rank(
    df: DataFrame, name: str, order: Sequence[str], bucket: Column, within: Sequence[str] = ()
) -> DataFrame:
    """Adds a dense 0-based position in the order."""
    return totals_before(df, order, bucket, {name: F.lit(1).cast("bigint")}, within)


def even_bucket(df: DataFrame, key: str, ranges: int = RANGES) -> Column:
    """Ranges of an integer key that are about equally full, however the key is distributed.

    The splitters are quantiles of a mergeable sketch (KLL), whose rank error is about a quarter of a range, so the fullest
    range stays under twice the mean.  The sketch is one job; a row finds its range by
    looking at about the square root of their number, twice.  Equal keys are in one range; null is in the first.
    """
    if ranges < 2:
        return F.lit(0)
    step = max(2, round(ranges**0.5))
    size = min(65_535, max(200, int((2.296 * 4 * ranges) ** 1.11)))  # the sketch's published error is 2.296 / size ^ 0.9021
    marks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    sketch = F.kll_sketch_agg_bigint(F.col(key).cast("bigint"), F.lit(size))
    cuts = df.where(F.col(key).isNotNull()).agg(F.when(F.count(key) > 0, F.kll_sketch_get_quantile_bigint(sketch, marks))).first()[0]
    if not cuts:
        return F.lit(0).cast("bigint")
    value = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    block = F.size(F.filter(literal_array(cuts[step - 1 :: step]), lambda x: x <= value))
    inside = F.size(F.filter(F.slice(literal_array(cuts), block * step + 1, F.lit(step)), lambda x: x <= value))
    return (block * step + inside).cast("bigint")


def sample_limits(
    df: DataFrame,
    k: Column | int,
    u: str,
    key: str,
    within: Sequence[str] = (),
    groups: int | None = None,
    bits: int = BUCKET_BITS,
    distinct: bool = False,
    levels: int = 1,
) -> DataFrame:
    """Draw and key of the k-th row in (draw, key) order, per group; no row for a group of fewer than k.

    Narrow passes: counts per range of the draw, which merge by addition, name the range that crosses k; that range is
    counted again by finer ranges, ``levels`` times in all; the rows of the last one are put in order.  ``groups`` is a known bound
    on the number of groups, if there is one.  ``distinct`` counts a key once however many rows it has.
    A NULL in ``within`` is a group like any other.
    """
    k = F.lit(k) if isinstance(k, int) else k
    keys = [*within, "_bucket"]
    across = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_bucket")
    bound = (groups or 1) if groups is not None or not within else None
    rows = df.select(*within, u, key, draw_bucket(F.col(u), bits).alias("_bucket"), k.alias("_need"))
    for level in range(1, levels + 1):
        if level > 1:
            rows = rows.withColumn("_bucket", draw_bucket(F.col(u), min(DRAW_BITS, bits * level)))
        counted = (
            (rows.distinct() if distinct else rows)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.first("_need").alias("_k"))
            .withColumn("_upto", F.sum("_n").over(across))
        )
        crossing = counted.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k"))).select(
            *keys, (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_need")
        )
        rows = null_safe_join(rows.drop("_need"), broadcast_within(crossing, bound), keys)
    inside = Window.partitionBy(*keys).orderBy(u, key)
    return (
        (rows.distinct() if distinct else rows)
        .withColumn("_rank", F.row_number().over(inside))
        .where(F.col("_rank") == F.col("_need"))
        .select(*within, F.col(u).alias("_limit_draw"), F.col(key).alias("_limit_key"))
    )


def group_bounds(df: DataFrame, within: Sequence[str]) -> tuple[int, int]:
    """(number of groups, rows of the largest), by one pass with partial counts."""
    sizes = df.groupBy(*within).agg(F.count(F.lit(1)).alias("_n"))
    row = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("_n"), F.lit(0))).first()
    return row[0], row[1]


def in_sample(u: str, key: str, k: Column | int) -> Column:
    """Row test against the columns of :func:`sample_limits`."""
    k = F.lit(k) if isinstance(k, int) else k
    before = (F.col(u) < F.col("_limit_draw")) | (
        (F.col(u) == F.col("_limit_draw")) & (F.col(key) <= F.col("_limit_key"))
    )
    return F.when(k <= F.lit(0), F.lit(False)).when(F.col("_limit_draw").isNull(), F.lit(True)).otherwise(before)


def sample_exactly(
    df: DataFrame,
    k: Column | int,
    u: str,
    key: str,
    within: Sequence[str] = (),
    groups: int | None = None,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Exactly k rows per group, or all of a smaller group.

    A limit per group filters the rows where they are: they are not shuffled.  Without a known bound ``groups`` the groups are
    counted first (a job); their largest size sets how often the crossing range is refined.  The limits
    of at most ``BROADCAST_ROWS`` groups are broadcast; beyond that, groups are joined with their limits by a salted shuffle.
    """
    levels = 1
    if within and groups is None:
        groups, largest = group_bounds(df, within)
        while largest >> (bits * levels) > CANDIDATE_ROWS and bits * levels < DRAW_BITS:
            levels += 1
    limits = sample_limits(df, k, u, key, within, groups, bits, levels=levels)
    if within:
        sided = dimension_lookup(df, limits, within, groups, null_safe=True)
    else:
        limit = limits.select(F.struct("_limit_draw", "_limit_key")).scalar()
        sided = df.withColumn("_limit", limit).select(
            *df.columns,
            F.col("_limit._limit_draw").alias("_limit_draw"),
            F.col("_limit._limit_key").alias("_limit_key"),
        )
    return sided.where(in_sample(u, key, k)).select(*df.columns)


def greedy_cover(
    df: DataFrame,
    weight: str,
    u: str,
    key: str,
    share: tuple[int, int],
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Rows taken in (draw, key) order while the weight taken before them is under share * total.

    ``share`` is a fraction (numerator, denominator); the row that crosses the target is kept.
    Weights are integers, so the sums do not depend on the order of addition.
    """
    num, den = share
    total = df.select(F.sum(weight)).scalar()
    running = totals_before(df, [u, key], draw_bucket(F.col(u), bits), {"_before": F.col(weight)})
    wide = "decimal(38,0)"
    return running.where(F.col("_before").cast(wide) * F.lit(den) < total.cast(wide) * F.lit(num)).drop("_before")
