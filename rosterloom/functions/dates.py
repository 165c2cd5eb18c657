"""Month-end and tenure helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIAL_DAYS = 90
QUARTER_MONTHS = (3, 6, 9, 12)


def month_end(start: Column, month_no: Column) -> Column:
    """Month end ``month_no`` months after ``start``."""
    return F.last_day(F.add_months(start, month_no.cast("int")))


def month_ends(start: Column, months: Column) -> Column:
    """Array of the month ends from ``start`` on."""
    return F.transform(
        F.sequence(F.lit(0), months.cast("int") - F.lit(1)), lambda i: F.last_day(F.add_months(start, i))
    )


def tenure_days(day: Column, hire_date: Column) -> Column:
    return F.datediff(day, hire_date)


def on_trial(days: Column) -> Column:
    return (days < F.lit(TRIAL_DAYS)).cast("int")


def is_quarter_end(day: Column) -> Column:
    return F.month(day).isin(*QUARTER_MONTHS)
