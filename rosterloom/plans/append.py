"""A panel that grows by one month at a time.

Beside the panel lies a *state* table with a folder per month: one narrow row per slot with the occupant and the traces of
all events so far.  A new month is made from the state of the month before, so its cost does not depend on
how many months there are.  Both folders of the month are replaced as a whole: a job that failed half-way, or
was started twice, is run again and leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.plans.org import Organisation
from rosterloom.plans.panel import panel_of
from rosterloom.plans.roster import PanelSpec, Slots, next_month, roster, with_events
from rosterloom.sources.panel_io import write_panel
from rosterloom.sources.schema import PANEL_COLUMNS

STATE = """slot_key bigint, slot bigint, report_date date, last_quarter int, hire_month int, emp_no bigint, hire_report_date date,
is_manager boolean, title_month int, move_month int, promotions bigint, raise_month int, quarter_month int, month_no int"""


def _write_state(rows: DataFrame, path: str) -> None:
    columns = [c.split()[:2] for c in STATE.replace("\n", " ").split(",")]
    narrow = rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns])
    narrow.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_no").parquet(path)


def state_of(spark: SparkSession, path: str, month: int) -> DataFrame:
    """The state of one month; only its folder is read."""
    rows = spark.read.schema(STATE).parquet(path).where(F.col("month_no") == month)
    if rows.isEmpty():
        raise ValueError(f"the state of month {month} has not been stored")
    return rows


def start_panel(
    spark: SparkSession, slots: Slots, org: Organisation, spec: PanelSpec, path: str, state: str, columns: Sequence[str] = tuple(PANEL_COLUMNS)
) -> None:
    """A full build of ``spec.months`` months, with the state of the last one."""
    held = with_events(roster(spark, slots, spec), slots, spec)
    write_panel(panel_of(held, slots, org, spec, columns), path)
    _write_state(held.where(F.col("month_no") == spec.months - 1), state)


def append_month(
    spark: SparkSession, slots: Slots, org: Organisation, spec: PanelSpec, month: int, path: str, state: str, columns: Sequence[str] = tuple(PANEL_COLUMNS)
) -> None:
    """Adds month ``month`` (0-based) to panel and state; running it again replaces the month by the same rows."""
    if month < 1:
        raise ValueError("the first month is built by start_panel")
    _write_state(next_month(state_of(spark, state, month - 1), month, slots, spec), state)
    rows = panel_of(state_of(spark, state, month), slots, org, replace(spec, months=month + 1), columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("report_date").parquet(path)
