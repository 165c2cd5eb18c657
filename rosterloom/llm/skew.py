"""Equi joins in which one key may hold a third of all rows, and tables in which one row may be repeated that often."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.sources.staging import materialize

#: A key is hot if it has more than this part of all rows, so there are fewer hot keys than this number.
HOT_PART = 10_000
#: Copies that one task lays out at a time.
COPIES_AT_ONCE = 1_000


def join_counted(rows: DataFrame, facts: DataFrame, on: list[str], count: str, total: int, hot_part: int = HOT_PART) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, which has a row per key with its number of rows.

    Facts of hot keys are broadcast: there are at most ``hot_part`` of them at any size.  The
    other keys are joined by shuffle, and none of them fills a task.  Keys are not null.
    """
    limit = max(1, total // hot_part)
    hot = F.broadcast(facts.where(F.col(count) > limit))
    cold = facts.where(F.col(count) <= limit)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(hot, on).unionByName(rest.join(cold, on))


def row_keys(doc_id: str, text: str) -> list[Column]:
    """128 bits of hash of id and text, as k1 and k2; places of nulls count, as a null leaves a hash as it is."""
    nulls = F.col(doc_id).isNull().cast("int") + F.lit(2) * F.col(text).isNull().cast("int")
    return [F.xxhash64(nulls, F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.lit(1), nulls, F.col(doc_id), F.col(text)).alias("k2")]


def repeated_rows(rows: DataFrame, on: list[str], count: str, total: int, hot_part: int = HOT_PART) -> DataFrame:
    """(``on``, ``count``) of the keys that hold more than a part of all ``total`` rows, fewer than ``hot_part``; computed at once.

    Keys are counted within tasks before they meet.  Keys are not null.
    """
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias(count))
    return materialize(counted.where(F.col(count) > max(1, total // hot_part)))


def one_of_each(rows: DataFrame, on: list[str]) -> DataFrame:
    """One of the rows of each key, which are equal; tasks drop their own copies before rows meet."""
    return rows.groupBy(*on).agg(*[F.max(c).alias(c) for c in rows.columns if c not in on])


def copies(rows: DataFrame, count: str, number: str, on: list[str]) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in ``number``; what one task lays out is bounded.

    A copy's number takes the place of a salt that hangs on the order of rows: recomputed, the same copies come out.
    """
    begins = rows.withColumn("_begin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1, F.lit(COPIES_AT_ONCE).cast("bigint"))))
    dealt = begins.repartition(*on, "_begin")
    own = F.sequence(F.col("_begin"), F.least(F.col("_begin") + F.lit(COPIES_AT_ONCE - 1), F.col(count) - 1))
    return dealt.withColumn(number, F.explode(own)).drop("_begin", count)
