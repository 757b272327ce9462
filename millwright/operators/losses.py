"""The six big losses per line, and severity ordering of alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.clock import in_shift_startup
from millwright.functions.numeric import sum_if
from millwright.operators.intervals import long_idle_by_line, status_intervals


def six_big_losses(events: DataFrame, status: DataFrame) -> DataFrame:
    """Breakdown, setup, idling, slow cycles, defects and start-up rejects per line."""
    kind = F.col("event_type")
    cycle = kind == schemas.CYCLE
    slow_ms = F.col("actual_cycle_time_ms") - F.col("ideal_cycle_time_ms")
    early = in_shift_startup(F.col("ts"))
    rejected = F.col("units_rejected")
    from_events = events.groupBy("line_id").agg(
        sum_if(kind == "FAULT", F.col("downtime_s")).alias("equipment_failure_s"),
        sum_if(kind == "CHANGEOVER", F.col("downtime_s")).alias("setup_s"),
        sum_if(cycle & (slow_ms > 0), slow_ms.cast("bigint")).alias("reduced_speed_ms"),
        sum_if(cycle & ~early, rejected).alias("process_defects"),
        sum_if(cycle & early, rejected).alias("startup_rejects"),
    )
    idle = long_idle_by_line(status_intervals(status))
    return from_events.join(idle, "line_id", "left").select(
        "line_id",
        "equipment_failure_s",
        "setup_s",
        F.coalesce("idle_stops", F.lit(0)).alias("idle_stops"),
        (F.coalesce("idle_us", F.lit(0)) / F.lit(1e6)).alias("idle_s"),
        "reduced_speed_ms",
        "process_defects",
        "startup_rejects",
    )


def severity_rank(severity: Column) -> Column:
    return (
        F.when(severity == "CRITICAL", 0)
        .when(severity == "HIGH", 1)
        .when(severity == "MEDIUM", 2)
        .when(severity == "LOW", 3)
        .otherwise(4)
    )
