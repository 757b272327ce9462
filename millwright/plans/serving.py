"""Dashboard queries over the metric, statistics and alert tables.

Where a dashboard repeats one statement per line, there is a single query for
all lines here, with ``wide`` giving one column per line for a given line list.
``as_of`` stands for "now"; None means the current time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.clock import newer_than, time_between
from millwright.functions.numeric import band, oee_class, round_metric
from millwright.operators import rollups
from millwright.operators.losses import severity_rank


def wide(series: DataFrame, value: str, lines: Sequence[str]) -> DataFrame:
    """A (time, line_id, value) series with one column per line."""
    return series.groupBy("time").pivot("line_id", list(lines)).agg(F.first(value))


def current_oee(metrics: DataFrame) -> DataFrame:
    latest = rollups.latest_by_line(metrics, ["oee"])
    percent = F.col("oee").cast("double") * 100
    return latest.select(
        "line_id", "time", percent.alias("oee_pct"), band(percent, schemas.OEE_STEPS).alias("band")
    )


def current_oee_class(metrics: DataFrame) -> DataFrame:
    latest = rollups.latest_by_line(metrics, ["oee"])
    percent = F.col("oee").cast("double") * 100
    return latest.select("line_id", percent.alias("oee_pct"), oee_class(percent).alias("oee_class"))


def open_alert_count(alerts: DataFrame) -> DataFrame:
    counted = alerts.filter(~F.col("acknowledged")).agg(F.count(F.lit(1)).alias("alerts"))
    return counted.withColumn("band", band(F.col("alerts"), schemas.OPEN_ALERT_STEPS))


def trend(
    table: DataFrame, value: str, *, factor: int = 1, start=None, end=None, line_id: str | None = None
) -> DataFrame:
    """One value over time, oldest first; rates are shown in percent with ``factor=100``."""
    rows = table.filter(time_between(F.col("time"), start, end))
    if line_id is not None:
        rows = rows.filter(F.col("line_id") == line_id)
    shown = F.col(value).cast("double") * factor if factor != 1 else F.col(value).cast("double")
    return rows.select("time", "line_id", shown.alias(value)).orderBy("time", "line_id")


def recent_trend(metrics: DataFrame, as_of, last: str = "5 MINUTES") -> DataFrame:
    return trend(metrics.filter(newer_than(F.col("time"), as_of, last)), "oee")


def active_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    # a machine has one alert at a moment
    return (
        alerts.filter(~F.col("acknowledged"))
        .orderBy(F.col("timestamp").desc(), "equipment_id")
        .limit(limit)
        .select(
            F.col("timestamp").alias("Time"),
            F.col("equipment_id").alias("Equipment"),
            F.col("line_id").alias("Line"),
            F.col("alert_type").alias("Alert Type"),
            F.col("severity").alias("Severity"),
            F.col("temperature_c").alias("Temp °C"),
            F.col("fault_code").alias("Fault Code"),
        )
    )


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    """All open alerts, most severe first, then newest first."""
    return (
        alerts.filter(~F.col("acknowledged"))
        .orderBy(severity_rank(F.col("severity")), F.col("timestamp").desc(), "equipment_id")
        .select("severity", "timestamp", "equipment_id", "line_id", "alert_type", "fault_code")
    )


def hourly_alerts(alerts: DataFrame, *, start=None, end=None) -> DataFrame:
    rows = alerts.filter(time_between(F.col("timestamp"), start, end))
    return rollups.alerts_per_hour(rows).orderBy("time", "line_id")


def alert_count(alerts: DataFrame, as_of, last: str = "24 HOURS") -> DataFrame:
    counted = alerts.filter(newer_than(F.col("timestamp"), as_of, last)).agg(
        F.count(F.lit(1)).alias("alerts")
    )
    return counted.withColumn("band", band(F.col("alerts"), schemas.DAILY_ALERT_STEPS))


def current_cpk(stats: DataFrame) -> DataFrame:
    return (
        rollups.at_newest_time(stats)
        .select(
            "line_id",
            F.col("rolling_cpk").cast("double").alias("rolling_cpk"),
            band(F.col("rolling_cpk"), schemas.CPK_STEPS).alias("band"),
        )
        .orderBy("line_id")
    )


def hourly_trend(hourly: DataFrame, *, start=None, end=None) -> DataFrame:
    return (
        hourly.filter(time_between(F.col("bucket"), start, end))
        .select(F.col("bucket").alias("time"), "line_id", (F.col("avg_oee") * 100).alias("oee_pct"))
        .orderBy("time", "line_id")
    )


def daily_trend(metrics: DataFrame, *, start=None, end=None) -> DataFrame:
    rows = metrics.filter(time_between(F.col("time"), start, end))
    return rollups.daily_oee(rows).orderBy("time", "line_id")


def worst_windows(metrics: DataFrame, *, start=None, end=None, limit: int = 20) -> DataFrame:
    def percent(name: str):
        return round_metric(F.col(name).cast("double") * 100, 1)

    return (
        metrics.filter(time_between(F.col("time"), start, end))
        .orderBy("oee", "time", "line_id")
        .limit(limit)
        .select(
            F.col("time").alias("Time"),
            F.col("line_id").alias("Line"),
            percent("oee").alias("OEE %"),
            percent("availability").alias("Avail %"),
            percent("performance").alias("Perf %"),
            percent("quality").alias("Quality %"),
            F.col("total_units").alias("Units"),
        )
    )
