"""Window-shaped steps over small groups (one employee, one block, one tribe)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _upto(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_forward(value: Column, keys: Sequence[str], order: str) -> Column:
    """Last value that is not NULL, up to the current row."""
    return F.last(value, ignorenulls=True).over(_upto(keys, order))


def last_event(happened: Column, keys: Sequence[str], order: str) -> Column:
    """Order value of the last row where ``happened`` holds; NULL before the first."""
    return F.max(F.when(happened, F.col(order))).over(_upto(keys, order))


def events_so_far(happened: Column, keys: Sequence[str], order: str) -> Column:
    return F.sum(F.when(happened, 1).otherwise(0)).over(_upto(keys, order))


def capped_growth(base: Column, steps: Column, cap: int) -> Column:
    return F.least(F.lit(cap).cast("bigint"), base.cast("bigint") + steps)


def counter_since(base: Column, reset_at: Column, now: Column, start: Column, step: int) -> Column:
    """``step`` per period since the last reset, or since ``start`` on top of ``base``."""
    return F.when(reset_at.isNotNull(), F.lit(step) * (now - reset_at)).otherwise(
        base + F.lit(step) * (now - start)
    )


def share_in_group(weight: Column, keys: Sequence[str], target: Column) -> Column:
    """Weight scaled so that a group adds up to ``target``."""
    return weight.cast("double") / F.sum(weight).over(Window.partitionBy(*keys)).cast("double") * target


def chunk_no(keys: Sequence[str], order: Sequence[str], wanted: Column) -> Column:
    """0-based chunk of a row when its group is cut into ``wanted`` equal chunks plus a remainder."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    pieces = F.greatest(F.lit(1), F.least(size, wanted))
    length = F.greatest(F.lit(1), F.floor(size / pieces))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - F.lit(1)
    return F.floor(position / length)
