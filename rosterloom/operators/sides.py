"""How the sides of a join are laid out: broadcast within a bound, else salted or spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SPREAD_ROWS = 50_000


def broadcast_within(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side of at most ``rows`` rows, if that bound is known and small."""
    return F.broadcast(df) if rows is not None and rows <= limit else df


def bounded_or_merged(df: DataFrame, rows: int | None) -> DataFrame:
    """A side that is broadcast within a known small bound and never beyond it.

    Sizes ahead of an ``explode`` are underestimated, so that without a hint the driver may be made to collect a large side.
    """
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df.hint("merge")


def spread(df: DataFrame, *keys: str, rows: int | None = None, rows_per_task: int = SPREAD_ROWS) -> DataFrame:
    """Hash-partitions narrow rows ahead of a step that makes them wide.

    The number of partitions is given, so that adaptive execution does not merge them by
    their small shuffled size and leave the expensive step to a few tasks.  Where the number of ``rows`` is known, a task
    gets about ``rows_per_task`` at most, however many there are.
    """
    spark = df.sparkSession
    if rows is None:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    else:
        n = max(-(-rows // rows_per_task), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def dimension_lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], rows: int | None = None, salts: int = 32,
    null_safe: bool = False,
) -> DataFrame:
    """Left join with a dimension that is unique on ``on``; with ``null_safe`` a NULL key finds the NULL row.

    Within a known small bound the dimension is broadcast.  Beyond it both sides are
    shuffled, each key split over ``salts`` so that a hot key does not fill one task.
    """
    on = list(on)
    if null_safe:
        return _null_safe_lookup(df, dim, on, rows, salts)
    if rows is not None and rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(dim), on, "left")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns[:8]), F.lit(salts)).cast("int"))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")


def null_safe_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which a NULL key equals a NULL key; the columns ``on`` are those of ``df``."""
    named = other.withColumnsRenamed({c: f"_other_{c}" for c in on})
    same = [df[c].eqNullSafe(named[f"_other_{c}"]) for c in on]
    return df.join(named, same, how).drop(*[f"_other_{c}" for c in on])


def _null_safe_lookup(df: DataFrame, dim: DataFrame, on: list[str], rows: int | None, salts: int) -> DataFrame:
    if rows is not None and rows <= BROADCAST_ROWS:
        return null_safe_join(df, F.broadcast(dim), on, "left")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns[:8]), F.lit(salts)).cast("int"))
    return null_safe_join(salted, copies, [*on, "_salt"], "left").drop("_salt")
