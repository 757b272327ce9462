"""Summaries over the metric, alert and event tables.

Averages run over decimal-exact values (see ``functions.numeric``), so they do
not depend on how rows were distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.clock import instant, newer_than
from millwright.functions.numeric import exact_mean, fine_mean, round_metric, share



#: size of the latency sketches: ranks within half a percent
SKETCH_K = 1024


def oee_hourly(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy(F.date_trunc("HOUR", "time").alias("bucket"), "line_id")
        .agg(
            exact_mean(F.col("oee"), 4).alias("avg_oee"),
            F.min("oee").cast("double").alias("min_oee"),
            F.max("oee").cast("double").alias("max_oee"),
            exact_mean(F.col("availability"), 4).alias("avg_availability"),
            exact_mean(F.col("performance"), 4).alias("avg_performance"),
            exact_mean(F.col("quality"), 4).alias("avg_quality"),
        )
    )


def complete_hours(metrics: DataFrame, as_of, start: str = "3 HOURS", end: str = "1 MINUTE") -> DataFrame:
    """Rows of the hours that lie wholly between ``as_of - start`` and ``as_of - end``."""
    hour = F.date_trunc("HOUR", "time")
    as_of = instant(as_of)
    return metrics.filter(
        (hour >= as_of - F.expr(f"INTERVAL {start}"))
        & (hour + F.expr("INTERVAL 1 HOUR") <= as_of - F.expr(f"INTERVAL {end}"))
        # the same range on the plain column, so that file statistics can be used
        & (F.col("time") >= as_of - F.expr(f"INTERVAL {start}"))
        & (F.col("time") <= as_of)
    )


def refreshed_hours(metrics: DataFrame, as_of) -> DataFrame:
    """Hourly rows a scheduled refresh at ``as_of`` recomputes."""
    return oee_hourly(complete_hours(metrics, as_of))


def daily_oee(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(F.date_trunc("DAY", "time").alias("time"), "line_id").agg(
        (exact_mean(F.col("oee"), 4) * 100).alias("oee_pct")
    )


def average_by_line(metrics: DataFrame, day=None) -> DataFrame:
    """Average effectiveness per line, of one day if given (a timestamp at its start)."""
    if day is not None:
        day = instant(day)
        metrics = metrics.filter(
            (F.col("time") >= day) & (F.col("time") < day + F.expr("INTERVAL 1 DAY"))
        )
    return metrics.groupBy("line_id").agg(
        exact_mean(F.col("oee"), 4).alias("avg_oee"), F.count(F.lit(1)).alias("windows")
    )


def low_oee_lines(metrics: DataFrame, as_of, threshold: float = 0.60, last: str = "2 MINUTES") -> DataFrame:
    """Lines whose average over the last minutes is below the threshold."""
    recent = metrics.filter(newer_than(F.col("time"), as_of, last))
    return (
        recent.groupBy("line_id")
        .agg(exact_mean(F.col("oee"), 4).alias("avg_oee"))
        .filter(F.col("avg_oee") < threshold)
    )


def availability_heatmap(metrics: DataFrame) -> DataFrame:
    """Average availability per line and hour of day."""
    return metrics.groupBy("line_id", F.hour("time").cast("bigint").alias("hour")).agg(
        exact_mean(F.col("availability"), 4).alias("availability")
    )


def latest_by_line(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Each line's newest row; (time, line) is a key, so there are no ties."""
    return metrics.groupBy("line_id").agg(
        F.max("time").alias("time"), *[F.max_by(c, "time").alias(c) for c in columns]
    )


def at_newest_time(stats: DataFrame) -> DataFrame:
    """Rows at the newest time of the whole table; lines missing there drop out."""
    return stats.filter(F.col("time") == stats.select(F.max("time")).scalar())


def alerts_per_hour(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.date_trunc("HOUR", "timestamp").alias("time"), "line_id").agg(
        F.count(F.lit(1)).alias("alerts")
    )


def alerts_by_line(alerts: DataFrame, as_of, last: str = "24 HOURS") -> DataFrame:
    return (
        alerts.filter(newer_than(F.col("timestamp"), as_of, last))
        .groupBy("line_id")
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


def failure_gaps(alerts: DataFrame, as_of, last: str = "7 DAYS") -> DataFrame:
    """Mean hours between alerts per line; null for a line with a single alert."""
    spread = F.max(F.unix_micros("timestamp")) - F.min(F.unix_micros("timestamp"))
    gaps = F.nullif(F.count(F.lit(1)) - 1, F.lit(0))
    return (
        alerts.filter(newer_than(F.col("timestamp"), as_of, last))
        .groupBy("line_id")
        .agg((spread / F.lit(1e6) / gaps / 3600).alias("hours"))
        .select("line_id", round_metric(F.col("hours"), 2).alias("mtbf_hours"))
    )


def production_quality(events: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Cycles, units and share of good units per configured line."""
    known = schemas.line_settings(events.sparkSession) if lines is None else lines
    totals = (
        events.filter(F.col("event_type") == schemas.CYCLE)
        .groupBy("line_id")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.coalesce(F.sum("units_produced"), F.lit(0)).alias("total_units"),
            F.coalesce(F.sum("units_rejected"), F.lit(0)).alias("rejected_units"),
        )
    )
    return totals.join(known.select("line_id"), "line_id", "left_semi").select(
        "*", share(F.col("total_units") - F.col("rejected_units"), F.col("total_units")).alias("quality")
    )


def daily_quality(events: DataFrame, as_of, last: str = "30 DAYS") -> DataFrame:
    """Good share per day and line, over events of every type."""
    made, lost = F.col("units_produced"), F.col("units_rejected")
    return (
        events.filter(newer_than(F.col("ts"), as_of, last))
        .groupBy(F.date_trunc("DAY", "ts").alias("day"), "line_id")
        .agg(
            (
                (F.sum(made - lost) / F.count(made - lost))
                / F.nullif(F.sum(made) / F.count(made), F.lit(0.0))
            ).alias("avg_quality")
        )
    )


def ingest_latency(events: DataFrame) -> DataFrame:
    """Median, 95th and 99th percentile of arrival delay, in milliseconds.

    Delays are counted per millisecond first; the percentiles are then taken
    over that histogram, whose size depends on the spread of the delays and not
    on the number of events.
    """
    delay = F.expr("(unix_micros(ingested_at) - unix_micros(ts)) div 1000")
    histogram = events.groupBy(delay.alias("ms")).agg(F.count(F.lit(1)).alias("n"))
    return histogram.agg(
        *[
            round_metric(F.percentile("ms", p, F.col("n")), 3).alias(name)
            for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99))
        ],
        F.sum("n").alias("events"),
    )


def latency_sketches(events: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per hour and line: a quantile sketch of the arrival delays in milliseconds, and how many there are.

    A sketch has a bounded size whatever the number and spread of the delays,
    is combined on the map side, and can be stored and merged later. A rank
    taken from it is off by about 2.3 / k^0.9 at most, with 99 % confidence.
    """
    delay = F.expr("(unix_micros(ingested_at) - unix_micros(ts)) div 1000").cast("double")
    return events.groupBy(F.date_trunc("HOUR", "ts").alias("bucket"), "line_id").agg(
        F.kll_sketch_agg_double(delay, F.lit(k)).alias("sketch"), F.count(delay).alias("events")
    )


def latency_from_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Median, 95th and 99th percentile of all merged sketches, or of each group's."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("events").alias("events"))
    return merged.select(
        *by,
        *[
            F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name)
            for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99))
        ],
        "events",
    )


def sensor_trend(status: DataFrame, window: str = "1 minute") -> DataFrame:
    """Average and peak sensor readings per machine and minute."""
    return (
        status.groupBy(F.window("ts", window).alias("span"), "equipment_id")
        .agg(
            *[fine_mean(F.col(c)).alias(f"avg_{c}") for c in _SENSORS],
            *[F.max(F.col(c).cast("double")).alias(f"max_{c}") for c in _SENSORS],
        )
        .select(F.col("span.end").alias("time"), "equipment_id", *_sensor_columns())
    )


_SENSORS = ("temperature_c", "vibration_hz", "power_kw")


def _sensor_columns() -> list[str]:
    return [f"{how}_{c}" for c in _SENSORS for how in ("avg", "max")]


def downtime_reasons(status: DataFrame, as_of, last: str = "24 HOURS") -> DataFrame:
    return (
        status.filter(newer_than(F.col("ts"), as_of, last) & (F.col("downtime_reason") != "NONE"))
        .groupBy("downtime_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def faults_per_hour(status: DataFrame, as_of, last: str = "7 DAYS") -> DataFrame:
    return (
        status.filter(newer_than(F.col("ts"), as_of, last) & (F.col("status") == schemas.FAULT))
        .groupBy(F.date_trunc("HOUR", "ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("faults"))
    )


def defect_types(batches: DataFrame, as_of, last: str = "24 HOURS") -> DataFrame:
    return (
        batches.filter(newer_than(F.col("ts"), as_of, last))
        .groupBy("defect_type")
        .agg(F.count(F.lit(1)).alias("batches"), F.sum("units_failed").alias("failed_units"))
    )
