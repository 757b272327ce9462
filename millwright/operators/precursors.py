"""Machines that ran hot or shook shortly before they faulted.

A reading above a limit arms its machine; a later benign reading changes
nothing; a fault disarms it and raises an alert if the arming reading is at
most thirty seconds old. Dropping all benign readings turns this into a
question about neighbours: a fault alerts exactly when the row before it is an
arming reading and close enough.

Only thirty seconds of history matter, so each machine's rows are cut into
time slots, and the rows in the last thirty seconds of a slot are shown to the
next slot as well. Machine and slot together are the shuffle key: one busy
machine spreads over as many tasks as it has slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright import schemas


SLOT_S = 300


def reading(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def above_limits(high_temperature: float, high_vibration: float) -> Column:
    return (reading("temperature_c") > high_temperature) | (reading("vibration_hz") > high_vibration)


def signal_rows(
    status: DataFrame,
    *,
    high_temperature: float = schemas.HIGH_TEMPERATURE_C,
    high_vibration: float = schemas.HIGH_VIBRATION_HZ,
    or_else: Column | None = None,
) -> DataFrame:
    """Faults and arming readings with just the columns an alert needs."""
    fault = F.coalesce(F.col("status"), F.lit("")) == schemas.FAULT
    wanted = fault | above_limits(high_temperature, high_vibration)
    return status.filter(wanted if or_else is None else wanted | or_else).select(
        F.coalesce("equipment_id", F.lit(schemas.UNKNOWN)).alias("equipment_id"),
        F.coalesce("line_id", F.lit("")).alias("line_id"),
        "ts",
        "event_id",
        fault.alias("is_fault"),
        reading("temperature_c").alias("temperature_c"),
        "fault_code",
    )


def alert_columns(temperature: Column) -> list[Column]:
    return [
        F.col("ts").alias("timestamp"),
        F.col("equipment_id"),
        F.col("line_id"),
        F.lit(schemas.ALERT_TYPE).alias("alert_type"),
        F.lit(schemas.ALERT_SEVERITY).alias("severity"),
        temperature.alias("temperature_c"),
        F.col("fault_code"),
        F.col("event_id"),
    ]


def in_slots(rows: DataFrame, within_s: int, slot_s: int) -> DataFrame:
    """Adds the time slot; a row near a slot's end also appears in the next one.

    ``home`` is the slot the row belongs to. A row at the end of its slot is
    copied once, as history for the rows that follow.
    """
    if slot_s < within_s:
        raise ValueError("a slot must be at least as long as the pattern window")
    within, width = within_s * 1_000_000, slot_s * 1_000_000
    return (
        rows.withColumn("us", F.unix_micros("ts"))
        .withColumn("home", F.expr(f"us div {width}"))
        .withColumn(
            "slot",
            F.explode(
                F.expr(f"if((home + 1) * {width} - us <= {within}, array(home, home + 1), array(home))")
            ),
        )
    )


def fault_precursors(
    status: DataFrame,
    *,
    high_temperature: float = schemas.HIGH_TEMPERATURE_C,
    high_vibration: float = schemas.HIGH_VIBRATION_HZ,
    within_s: int = schemas.PRECURSOR_WINDOW_S,
    slot_s: int = SLOT_S,
) -> DataFrame:
    """One row per fault that followed an arming reading; ``event_id`` is the fault's."""
    rows = signal_rows(status, high_temperature=high_temperature, high_vibration=high_vibration)
    order = Window.partitionBy("equipment_id", "slot").orderBy("us", "event_id")
    paired = in_slots(rows, within_s, slot_s).select(
        "*",
        F.lag("is_fault").over(order).alias("before_is_fault"),
        F.lag("us").over(order).alias("before_us"),
        F.lag("temperature_c").over(order).alias("before_temperature"),
    )
    return paired.filter(
        F.col("is_fault")
        & (F.col("slot") == F.col("home"))
        & ~F.col("before_is_fault")
        & (F.col("us") - F.col("before_us") <= within_s * 1_000_000)
    ).select(*alert_columns(F.col("before_temperature")))
