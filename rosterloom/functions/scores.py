"""Letter grades and rounding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER_SCORES: Mapping[str, int] = {"A": 5, "B": 4, "C": 3, "D": 2, "E": 1}


def letter_score(col: Column, scores: Mapping[str, int] = LETTER_SCORES) -> Column:
    """Score of a letter grade; NULL for any other letter."""
    expr = None
    for letter, score in scores.items():
        expr = (F.when if expr is None else expr.when)(col == F.lit(letter), F.lit(score))
    return expr


def half_even(col: Column) -> Column:
    """Round to an integer, halves to the even neighbour."""
    return F.bround(col, 0).cast("bigint")


def shortfall(total: Column, share_done: Column) -> Column:
    """Items left open: max(0, total - round(total * share))."""
    return F.greatest(F.lit(0).cast("bigint"), total.cast("bigint") - half_even(total * share_done))


def whole_div(a: Column, b: Column) -> Column:
    """Exact integer division of whole numbers; the result is a BIGINT."""
    return F.call_function("div", a, b)


def share_of(part: Column, whole: Column, of: Column | int) -> Column:
    """``of`` * ``part`` // ``whole``, exact although the product may exceed a BIGINT."""
    of = F.lit(of) if isinstance(of, int) else of
    exact = part.cast("decimal(19,0)") * of.cast("decimal(19,0)")
    return whole_div(exact, whole.cast("decimal(19,0)"))
