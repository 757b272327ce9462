"""How long each machine stayed in each status.

A status holds until the next event that changes it, which may be months
later, so a machine's history cannot simply be cut into independent pieces.
Cutting it into time slots and passing the slot borders on explicitly keeps
the result exact and the work spread: rows are only ever sorted within one
machine and slot, and only one summary row per machine and slot is sorted per
machine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.numeric import count_if, round_metric, seconds_between
from millwright.session import materialize

_SLOT_KEY = ["equipment_id", "slot"]


def slot_changes(status: DataFrame, slot_s: int, carry: Sequence[str] = ()) -> DataFrame:
    """Each slot's first row and the rows that change the status inside the slot.

    This is the only step that sorts the full history. All later steps depend on
    its rows alone, so it is written once and read from there.
    """
    rows = status.select(
        F.coalesce("equipment_id", F.lit(schemas.UNKNOWN)).alias("equipment_id"),
        F.coalesce("line_id", F.lit(schemas.UNKNOWN)).alias("line_id"),
        "ts",
        "event_id",
        F.coalesce("status", F.lit("")).alias("status"),
        F.expr(f"unix_seconds(ts) div {slot_s}").alias("slot"),
        *carry,
    )
    order = Window.partitionBy(*_SLOT_KEY).orderBy("ts", "event_id")
    changes = (
        rows.withColumn("before", F.lag("status").over(order))
        .filter(F.col("before").isNull() | (F.col("before") != F.col("status")))
        .select(
            *_SLOT_KEY,
            "line_id",
            "ts",
            "status",
            F.col("before").isNull().alias("opens"),
            F.lead("ts").over(order).alias("next_inside"),
            *carry,
        )
    )
    return materialize(changes)


def slot_borders(changes: DataFrame) -> DataFrame:
    """Per slot: whether its first row is a change, and when the next slots first change."""
    opening, closing = F.col("opens"), F.col("next_inside").isNull()
    # at most two rows of a slot matter here, whatever its size
    slots = changes.filter(opening | closing).groupBy(*_SLOT_KEY).agg(
        F.max(F.when(opening, F.col("status"))).alias("opening_status"),
        F.max(F.when(opening, F.col("ts"))).alias("opening_ts"),
        F.max(F.when(opening, F.col("next_inside"))).alias("second_ts"),
        F.max(F.when(closing, F.col("status"))).alias("closing_status"),
    )
    forward = Window.partitionBy("equipment_id").orderBy("slot")
    later = (
        Window.partitionBy("equipment_id")
        .orderBy(F.col("slot").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.lag("closing_status").over(forward)
    return (
        slots.withColumn(
            "opening_changes", carried.isNull() | (carried != F.col("opening_status"))
        )
        .withColumn(
            "first_change",
            F.when(F.col("opening_changes"), F.col("opening_ts")).otherwise(F.col("second_ts")),
        )
        .select(
            *_SLOT_KEY,
            "opening_changes",
            F.last("first_change", ignorenulls=True).over(later).alias("next_outside"),
        )
    )


def status_intervals(
    status: DataFrame, slot_s: int = 900, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per uninterrupted status; the current one has no end yet.

    ``carry`` names columns to take over from the event that opened the interval.
    """
    changes = slot_changes(status, slot_s, carry)
    ended = F.coalesce("next_inside", "next_outside")
    return (
        changes.join(slot_borders(changes), _SLOT_KEY)
        .filter(~F.col("opens") | F.col("opening_changes"))
        .select(
            "equipment_id",
            "line_id",
            "status",
            F.col("ts").alias("started"),
            ended.alias("ended"),
            seconds_between(F.col("ts"), ended).alias("seconds"),
            *carry,
        )
    )


def _micros(started: str = "started", ended: str = "ended"):
    return F.unix_micros(ended) - F.unix_micros(started)


def repair_time_by_line(intervals: DataFrame) -> DataFrame:
    """Mean time to repair: average length of the finished fault intervals."""
    return (
        intervals.filter((F.col("status") == schemas.FAULT) & F.col("ended").isNotNull())
        .groupBy("line_id")
        .agg(
            F.count(F.lit(1)).alias("repairs"),
            (F.sum(_micros()).cast("double") / F.count(F.lit(1)) / F.lit(60e6)).alias("minutes"),
        )
        .select("line_id", "repairs", round_metric(F.col("minutes"), 2).alias("mttr_minutes"))
    )


def long_idle_by_line(intervals: DataFrame, longer_than_s: int = 300) -> DataFrame:
    """Idle intervals longer than five minutes: how many and how long in all."""
    idle = intervals.filter((F.col("status") == "IDLE") & F.col("ended").isNotNull())
    return idle.groupBy("line_id").agg(
        count_if(_micros() > longer_than_s * 1_000_000).alias("idle_stops"),
        F.sum(F.when(_micros() > longer_than_s * 1_000_000, _micros()).otherwise(0)).alias("idle_us"),
    )
