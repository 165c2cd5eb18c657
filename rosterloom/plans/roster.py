"""Monthly roster with turnover, and the events in an employee's life.

Headcount is constant, so the roster is a set of *slots*: each slot is held by one
employee at a time.  Who leaves in a month is an exact sample of the slots; everything
that happens later follows from draws on the slot or the employee, without a loop.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions.dates import is_quarter_end, month_end
from rosterloom.functions.draws import DEFAULT_SEED, chance, draw
from rosterloom.functions.scores import half_even
from rosterloom.operators.ranking import draw_bucket, in_sample, sample_limits, with_rank
from rosterloom.operators.sides import broadcast_within, spread
from rosterloom.operators.windows import carry_forward, events_so_far, last_event

# Fixed value: number of the first employee.
FIRST_EMPLOYEE = 10_000_001
MAX_MONTHS = 1200
LEAVER_BITS = 18


@dataclass(frozen=True)
class PanelSpec:
    """Parameters of a panel."""

    start: datetime.date = datetime.date(2025, 10, 31)
    months: int = 6
    attrition: float = 0.015
    job_changes: float = 0.02
    seed: int = DEFAULT_SEED
    managers: float = 0.10
    backfill_managers: float = 0.05

    def __post_init__(self):
        if not 1 <= self.months <= MAX_MONTHS:
            raise ValueError(f"months must lie in 1..{MAX_MONTHS}")


@dataclass(frozen=True)
class Slots:
    """The slots of a panel.

    ``keys`` holds a unique BIGINT ``slot_key`` per slot; draws hang on it.  ``ranked`` adds the
    dense ordinal ``slot`` (0..n-1) that numbers employees and peers.  ``count`` is n.
    """

    keys: DataFrame
    ranked: DataFrame
    count: Column


def numbered_slots(spark: SparkSession, n: int) -> Slots:
    ids = spark.range(n)
    return Slots(
        ids.select(F.col("id").alias("slot_key")),
        ids.select(F.col("id").alias("slot_key"), F.col("id").alias("slot")),
        F.lit(n).cast("bigint"),
    )


def slots_from_keys(df: DataFrame, key: str, seed: int = DEFAULT_SEED) -> Slots:
    """One slot per row of ``df``; ``key`` is unique, but need not be dense."""
    keys = df.select(F.col(key).cast("bigint").alias("slot_key"))
    drawn = keys.withColumn("slot_u", draw("slot", "slot_key", seed=seed))
    ranked = with_rank(drawn, "slot", ["slot_u", "slot_key"], draw_bucket(F.col("slot_u")))
    return Slots(keys, ranked.select("slot_key", "slot"), keys.select(F.count(F.lit(1))).scalar())


def month_spine(spark: SparkSession, spec: PanelSpec) -> DataFrame:
    """month_no, report_date, and the last quarter month after the start up to that month."""
    spine = spark.range(spec.months).select(
        F.col("id").cast("int").alias("month_no"), month_end(F.lit(spec.start), F.col("id")).alias("report_date")
    )
    refreshed = F.when((F.col("month_no") > 0) & is_quarter_end(F.col("report_date")), F.col("month_no"))
    return spine.withColumn("_all", F.lit(0)).select(
        "month_no", "report_date", carry_forward(refreshed, ["_all"], "month_no").alias("last_quarter")
    )


def _monthly(slots: Slots, spec: PanelSpec, name: str, first: int) -> DataFrame:
    """(slot_key, month_no, event_u) for the months from ``first`` on."""
    months = [F.lit(m) for m in range(first, spec.months)] or [F.lit(None).cast("int")]
    return (
        slots.keys.select("slot_key", F.explode(F.array(*months)).alias("month_no"))
        .where(F.col("month_no").isNotNull())
        .withColumn("event_u", draw(name, "slot_key", "month_no", seed=spec.seed))
    )


def monthly_quota(slots: Slots, rate: float) -> Column:
    return half_even(slots.count * F.lit(rate))


def leavers(slots: Slots, spec: PanelSpec, first: int = 1) -> DataFrame:
    """(slot_key, month_no, event_u) of each leaver from month ``first`` on; their places are filled in the same month."""
    moves = _monthly(slots, spec, "leave", first)
    quota = monthly_quota(slots, spec.attrition)
    limits = sample_limits(moves, quota, "event_u", "slot_key", ["month_no"], groups=spec.months)
    sided = moves.join(broadcast_within(limits, spec.months), "month_no", "left")
    return sided.where(in_sample("event_u", "slot_key", quota)).select("slot_key", "month_no", "event_u")


def hires(slots: Slots, spec: PanelSpec, first: int = 1) -> DataFrame:
    """(slot_key, month_no, emp_no) of each backfill; numbers run on month by month without gaps."""
    # Leavers hold the lowest draws of their month, so their ranges are cut finer.
    ranges = draw_bucket(F.col("event_u"), LEAVER_BITS)
    ranked = with_rank(leavers(slots, spec, first), "_rank", ["event_u", "slot_key"], ranges, ["month_no"])
    before = (F.col("month_no") - F.lit(1)).cast("bigint") * monthly_quota(slots, spec.attrition)
    return ranked.select(
        "slot_key", "month_no", (F.lit(FIRST_EMPLOYEE) + slots.count + before + F.col("_rank")).alias("emp_no")
    )


def roster(spark: SparkSession, slots: Slots, spec: PanelSpec) -> DataFrame:
    """One row per slot and month: slot_key, slot, month_no, report_date, last_quarter, hire_month,
    hire_report_date, emp_no, is_manager.

    Slots and backfills meet on the slot before the months are laid out, so that only
    two narrow columns are shuffled; all later steps keep that partitioning.
    """
    by_slot = (
        hires(slots, spec)
        .groupBy("slot_key")
        .agg(F.sort_array(F.collect_list(F.struct("month_no", "emp_no"))).alias("_hires"))
    )
    laid_out = (
        spread(slots.ranked, "slot_key")
        .join(by_slot, "slot_key", "left")
        .withColumn("month_no", F.explode(F.sequence(F.lit(0), F.lit(spec.months - 1))))
        .join(broadcast_within(month_spine(spark, spec), spec.months), "month_no")
    )
    so_far = F.filter("_hires", lambda h: h["month_no"] <= F.col("month_no"))
    held = laid_out.withColumn("_last", F.try_element_at(so_far, F.lit(-1))).select(
        "slot_key", "slot", "month_no", "report_date", "last_quarter",
        F.coalesce(F.col("_last.month_no"), F.lit(0)).alias("hire_month"),
        F.coalesce(F.col("_last.emp_no"), F.lit(FIRST_EMPLOYEE) + F.col("slot")).alias("emp_no"),
    )
    u = draw("manager", "emp_no", seed=spec.seed)
    return held.select(
        "*",
        month_end(F.lit(spec.start), F.col("hire_month")).alias("hire_report_date"),
        F.when(F.col("hire_month") == 0, chance(u, spec.managers))
        .otherwise(chance(u, spec.backfill_managers))
        .alias("is_manager"),
    )


def hire_rows(spark: SparkSession, slots: Slots, spec: PanelSpec, events: bool = True) -> DataFrame:
    """The rows of :func:`with_events` in each employee's month of hire, one per employee.

    The first population and the backfills are put side by side; no other month is laid out.  Without
    ``events`` only the quarter is known, and months of other events are NULL.
    """
    first = slots.ranked.select("slot_key", "slot", F.lit(0).alias("month_no"), (F.lit(FIRST_EMPLOYEE).cast("bigint") + F.col("slot")).alias("emp_no"))
    later = hires(slots, spec).join(slots.ranked, "slot_key").select("slot_key", "slot", "month_no", "emp_no")
    spine = broadcast_within(month_spine(spark, spec), spec.months)
    u = draw("manager", "emp_no", seed=spec.seed)
    rows = first.unionByName(later).join(spine, "month_no").select(
        "slot_key", "slot", "month_no", "report_date", "last_quarter", F.col("month_no").alias("hire_month"), "emp_no",
        F.when(F.col("month_no") == 0, chance(u, spec.managers)).otherwise(chance(u, spec.backfill_managers)).alias("is_manager"),
        F.col("report_date").alias("hire_report_date"),
    )
    quarter = F.when(F.col("last_quarter") >= F.greatest(F.lit(1), F.col("hire_month")), F.col("last_quarter")).alias("quarter_month")
    if events:
        return with_events(rows, slots, spec)
    none = F.lit(None).cast("int")
    return rows.select("*", *[none.alias(c) for c in ("title_month", "move_month", "raise_month")], F.lit(0).cast("bigint").alias("promotions"), quarter)


OCCUPANT = ["slot_key", "hire_month", "emp_no", "hire_report_date", "is_manager"]


def with_events(held: DataFrame, slots: Slots, spec: PanelSpec) -> DataFrame:
    """Adds what has happened to the employee so far: title_month, move_month, promotions,
    raise_month, quarter_month (each NULL or 0 before the first such event).
    """
    quota = monthly_quota(slots, spec.job_changes)
    limits = sample_limits(_monthly(slots, spec, "change", 1), quota, "event_u", "slot_key", ["month_no"], groups=spec.months)
    drawn = held.withColumn("event_u", draw("change", "slot_key", "month_no", seed=spec.seed)).join(
        broadcast_within(limits, spec.months), "month_no", "left"
    )
    later = F.col("month_no") > 0
    changed = later & in_sample("event_u", "slot_key", quota)

    def happens(name: str, p: float) -> Column:
        return chance(draw(name, "emp_no", "month_no", seed=spec.seed), p)

    flagged = drawn.select(
        *held.columns,
        changed.alias("_changed"),
        (changed & happens("move", 0.3)).alias("_moved"),
        (changed & happens("promote", 0.3)).alias("_promoted"),
        (later & happens("raise", 0.03)).alias("_raised"),
    )
    return flagged.select(
        *held.columns,
        last_event(F.col("_changed"), OCCUPANT, "month_no").alias("title_month"),
        last_event(F.col("_moved"), OCCUPANT, "month_no").alias("move_month"),
        events_so_far(F.col("_promoted"), OCCUPANT, "month_no").alias("promotions"),
        last_event(F.col("_raised"), OCCUPANT, "month_no").alias("raise_month"),
        F.when(F.col("last_quarter") >= F.greatest(F.lit(1), F.col("hire_month")), F.col("last_quarter")).alias(
            "quarter_month"
        ),
    )


def next_month(held: DataFrame, month: int, slots: Slots, spec: PanelSpec) -> DataFrame:
    """The rows of :func:`with_events` for ``month`` from those of the month before, without looking further back.

    One row per slot carries all that the past has left: the occupant, the months of the last events, the promotions.
    A backfill starts anew; what happens to anyone in the month is drawn as in a full build.
    """
    only = replace(spec, months=month + 1)
    quota = monthly_quota(slots, spec.job_changes)
    limits = sample_limits(_monthly(slots, only, "change", month), quota, "event_u", "slot_key", ["month_no"], groups=1)
    new = hires(slots, only, month).select("slot_key", F.col("emp_no").alias("_new"))
    report_date = month_end(F.lit(spec.start), F.lit(month))
    quarter = F.when(is_quarter_end(report_date), F.lit(month)).otherwise(F.col("last_quarter"))
    hired = F.col("_new").isNotNull()
    moved_on = held.drop("month_no", "report_date").join(new, "slot_key", "left").select(
        "slot_key", "slot", F.lit(month).alias("month_no"), report_date.alias("report_date"), quarter.alias("last_quarter"),
        F.when(hired, F.lit(month)).otherwise(F.col("hire_month")).alias("hire_month"),
        F.when(hired, report_date).otherwise(F.col("hire_report_date")).alias("hire_report_date"),
        F.coalesce("_new", "emp_no").alias("emp_no"),
        F.when(hired, chance(draw("manager", "_new", seed=spec.seed), spec.backfill_managers)).otherwise(F.col("is_manager")).alias("is_manager"),
        *[F.when(~hired, F.col(c)).alias(c) for c in ("title_month", "move_month", "raise_month")],
        F.when(hired, F.lit(0)).otherwise(F.col("promotions")).alias("promotions"),
    )
    drawn = moved_on.withColumn("event_u", draw("change", "slot_key", "month_no", seed=spec.seed)).join(broadcast_within(limits, 1), "month_no", "left")
    changed = in_sample("event_u", "slot_key", quota)

    def happens(name: str, p: float) -> Column:
        return chance(draw(name, "emp_no", "month_no", seed=spec.seed), p)

    def latest(now: Column, column: str) -> Column:
        return F.when(now, F.lit(month)).otherwise(F.col(column)).alias(column)

    return drawn.select(
        "slot_key", "slot", "month_no", "report_date", "last_quarter", "hire_month", "emp_no", "hire_report_date", "is_manager",
        latest(changed, "title_month"),
        latest(changed & happens("move", 0.3), "move_month"),
        (F.col("promotions") + (changed & happens("promote", 0.3)).cast("bigint")).alias("promotions"),
        latest(happens("raise", 0.03), "raise_month"),
        F.when(F.col("last_quarter") >= F.greatest(F.lit(1), F.col("hire_month")), F.col("last_quarter")).alias("quarter_month"),
    )
