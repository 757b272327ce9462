"""Overall equipment effectiveness.

All inputs are algebraic sums, so Spark aggregates on the map side before the
shuffle; a line that holds a third of all events costs one partial row per
task and window, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.numeric import round_metric, round_text, text_literal


def production_totals(downtime_types: Sequence[str] = schemas.DOWNTIME_EVENT_TYPES) -> list[Column]:
    """Aggregates: seconds down, units made and units good.

    Cycle events never count as downtime, and only cycle events make units;
    groups without any cycle keep their row.
    """
    stops = ", ".join(text_literal(kind) for kind in downtime_types)
    cycle = f"event_type = {text_literal(schemas.CYCLE)}"
    made, lost = "coalesce(units_produced, 0)", "coalesce(units_rejected, 0)"
    return [
        F.expr(f"sum(if(event_type IN ({stops}), coalesce(downtime_s, 0), 0)) AS down_s"),
        F.expr(f"sum(if({cycle}, {made}, 0)) AS total_units"),
        F.expr(f"sum(if({cycle}, {made} - {lost}, 0)) AS good_units"),
    ]


def with_ideal_cycle(totals: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Adds each line's ideal cycle time, 5000 ms for lines without settings."""
    settings = schemas.line_settings(totals.sparkSession) if lines is None else lines
    ideal = settings.select("line_id", F.col("ideal_cycle_time_ms").alias("configured_ms"))
    return totals.join(ideal, "line_id", "left").withColumn(
        "ideal_ms", F.coalesce("configured_ms", F.lit(schemas.DEFAULT_IDEAL_CYCLE_MS))
    ).drop("configured_ms")


def rate_totals(
    totals: DataFrame, keys: Sequence[str], planned_time_s: int = schemas.PLANNED_TIME_S
) -> DataFrame:
    """Availability, performance, quality and their product from production totals."""
    up_s = f"({int(planned_time_s)} - down_s)"
    rated = totals.selectExpr(
        *keys,
        f"greatest(0D, {up_s} / {int(planned_time_s)}) AS a",
        f"if(total_units > 0, least(1D, total_units * ideal_ms / greatest(1, {up_s} * 1000)), 0D) AS p",
        "if(total_units > 0, good_units / total_units, 0D) AS q",
        "total_units",
        "good_units",
    )
    return rated.selectExpr(
        *keys,
        f"{round_text('a', 4)} AS availability",
        f"{round_text('p', 4)} AS performance",
        f"{round_text('q', 4)} AS quality",
        f"{round_text('a * p * q', 4)} AS oee",
        "total_units",
        "good_units",
    )


def oee_by_window(
    events: DataFrame,
    *,
    window: str = f"{schemas.OEE_WINDOW_S} seconds",
    planned_time_s: int = schemas.PLANNED_TIME_S,
    downtime_types: Sequence[str] = schemas.DOWNTIME_EVENT_TYPES,
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per line and tumbling event-time window; ``time`` is the window end.

    Runs unchanged on a watermarked stream.
    """
    totals = (
        events.groupBy(
            F.window("ts", window).alias("span"),
            F.coalesce("line_id", F.lit(schemas.UNKNOWN)).alias("line_id"),
        )
        .agg(*production_totals(downtime_types))
        .withColumn("time", F.col("span.end"))
    )
    return rate_totals(with_ideal_cycle(totals, lines), ["time", "line_id"], planned_time_s)


def oee_against_target(metrics: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Each window's effectiveness next to its line's target; lines without one are left out."""
    settings = schemas.line_settings(metrics.sparkSession) if lines is None else lines
    return metrics.join(settings.select("line_id", "target_oee"), "line_id").select(
        "time",
        "line_id",
        "oee",
        "target_oee",
        round_metric(F.col("oee") - F.col("target_oee"), 4).alias("gap"),
        (F.col("oee") >= F.col("target_oee")).alias("on_target"),
    )
