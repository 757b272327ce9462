"""Every operator as a runnable query over the supplied tables.

Each entry takes a session and a data folder and returns a DataFrame computed
from the whole ``events`` table through the plant views. ``now`` is the newest
event time of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import cached_property, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.coerce import iso_time
from millwright.operators import bursts, capability, charts, enrich, intervals, losses, oee, precursors, rollups
from millwright.plans import serving
from millwright.session import scratch_path, use_utc
from millwright.sinks import archive, compaction, folders, tables
from millwright.sources import feeds, message_log, plant_views
from millwright.streaming import jobs, progress

Query = Callable[[SparkSession, str], DataFrame]

# built once per session and data folder: (application, folder) -> archive root
_ARCHIVES: dict[tuple[str, str], str] = {}

# (application, folder, pace) -> root of the tables and the newest event time
_BOARDS: dict[tuple[str, str, int], tuple[str, datetime]] = {}

# the second and the third snapshot start here
_SNAPSHOT_BOUNDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
_OPERATOR_ID = T.StructType([T.StructField("operator_id", T.StringType())])


class Plant:
    """The feeds and metric tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, pace: int = plant_views.DENSE):
        self.spark = use_utc(spark)
        self.sf_dir = sf_dir
        self.pace = pace
        self.events = plant_views.event_log(spark, sf_dir)

    @cached_property
    def line_events(self) -> DataFrame:
        return plant_views.line_events(self.events, self.pace)

    @cached_property
    def equipment_status(self) -> DataFrame:
        return plant_views.equipment_status(self.events, self.pace)

    @cached_property
    def quality_metrics(self) -> DataFrame:
        return plant_views.quality_metrics(self.events, self.pace)

    @property
    def now(self) -> Column:
        return self.line_events.select(F.max("ts")).scalar()

    @property
    def metrics(self) -> DataFrame:
        return oee.oee_by_window(self.line_events)

    @property
    def stats(self) -> DataFrame:
        return capability.rolling_cpk(self.quality_metrics)

    @property
    def alerts(self) -> DataFrame:
        return precursors.fault_precursors(self.equipment_status)


def _calendar(spark: SparkSession, sf_dir: str) -> Plant:
    return Plant(spark, sf_dir, pace=1)


def _acknowledge_some(spark: SparkSession, path: str) -> None:
    """Operators take note of mechanical and electrical faults, then open those of every fifth minute again."""
    raised = tables.read_alerts(spark, path).filter(F.col("fault_code") < "E-200")
    for entry, minutes, kept in (("again", 9, F.minute("timestamp") % 5 == 0), ("first", 5, F.lit(True))):
        said = raised.filter(kept).select(
            "id", "timestamp", F.lit(entry == "first").alias("acknowledged"),
            F.timestamp_add("MINUTE", F.lit(minutes), "timestamp").alias("said_at"), F.lit("operator").alias("said_by"),
        )
        tables.acknowledge(path, said, entry=entry)


class Board:
    """The stored metric tables and alerts that dashboards read, filled once per session and data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, pace: int = plant_views.DENSE):
        self.spark = use_utc(spark)
        key = (spark.sparkContext.applicationId, sf_dir, pace)
        if key not in _BOARDS or not folders.exists(spark, _BOARDS[key][0]):
            plant = Plant(spark, sf_dir, pace)
            root = scratch_path(spark, "board")
            tables.upsert_oee_metrics(f"{root}/oee", plant.metrics, batch=0)
            tables.upsert_quality_stats(f"{root}/quality", plant.stats, batch=0)
            tables.upsert_hourly(
                f"{root}/hourly", rollups.oee_hourly(tables.read_table(spark, f"{root}/oee", schemas.OEE_METRICS)), batch=0
            )
            tables.append_alerts(f"{root}/alerts", plant.alerts, batch=0, run="r")
            _acknowledge_some(spark, f"{root}/alerts")
            newest = plant.line_events.agg(F.unix_micros(F.max("ts"))).first()[0]
            _BOARDS[key] = (root, datetime(1970, 1, 1) + timedelta(microseconds=newest or 0))
        self.root, self.now = _BOARDS[key]

    def metrics(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        return tables.read_between(self.spark, f"{self.root}/oee", schemas.OEE_METRICS, start, end)

    def stats(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        return tables.read_between(self.spark, f"{self.root}/quality", schemas.QUALITY_STATS, start, end)

    def hourly(self) -> DataFrame:
        return tables.read_hourly(self.spark, f"{self.root}/hourly")

    def newest_metrics(self) -> DataFrame:
        return tables.newest_of_lines(self.spark, f"{self.root}/oee", schemas.OEE_METRICS)

    def newest_stats(self) -> DataFrame:
        return tables.newest_hour(self.spark, f"{self.root}/quality", schemas.QUALITY_STATS)

    def worst_metrics(self, k: int) -> DataFrame:
        return tables.smallest(self.spark, f"{self.root}/oee", schemas.OEE_METRICS, "oee", k)

    def alerts(self, since: datetime | None = None) -> DataFrame:
        return tables.read_alerts(self.spark, f"{self.root}/alerts", since)


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps and decimals as doubles, for comparison elsewhere."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast(
            "timestamp_ntz" if isinstance(f.dataType, T.TimestampType) else "double"
        )
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.DecimalType))
    }
    return df.withColumns(casts) if casts else df


# --- metric operators --------------------------------------------------------


def oee_by_window(spark, sf_dir):
    return Plant(spark, sf_dir).metrics


def oee_by_hour_window(spark, sf_dir):
    return oee.oee_by_window(Plant(spark, sf_dir).line_events, window="1 hour")


def oee_fault_downtime_only(spark, sf_dir):
    return oee.oee_by_window(
        Plant(spark, sf_dir).line_events, downtime_types=("FAULT",), planned_time_s=1800
    )


def rolling_cpk(spark, sf_dir):
    return Plant(spark, sf_dir).stats


def rolling_cpk_fine(spark, sf_dir):
    """Capability over readings with seven decimals and small spreads with nine."""
    plant = Plant(spark, sf_dir)
    steps = F.col("event_id") % 9973
    fine = plant.quality_metrics.withColumns(
        {
            "measured_mean": F.col("measured_mean") + steps / 10000000,
            "measured_stddev": F.col("measured_stddev") / 100 + steps / 1000000000,
        }
    )
    return capability.rolling_cpk(fine)


def fault_precursors(spark, sf_dir):
    return Plant(spark, sf_dir).alerts


def oee_against_target(spark, sf_dir):
    return oee.oee_against_target(Plant(spark, sf_dir).metrics)


# --- rollups -----------------------------------------------------------------


def oee_hourly_rollup(spark, sf_dir):
    return rollups.oee_hourly(Plant(spark, sf_dir).metrics)


def oee_hourly_refresh(spark, sf_dir):
    plant = Plant(spark, sf_dir)
    return rollups.refreshed_hours(plant.metrics, plant.now)


def daily_oee(spark, sf_dir):
    return serving.daily_trend(_calendar(spark, sf_dir).metrics)


def alerts_per_hour(spark, sf_dir):
    return serving.hourly_alerts(Board(spark, sf_dir).alerts())


def alerts_last_day(spark, sf_dir):
    board = Board(spark, sf_dir)
    return serving.alert_count(board.alerts(board.now - timedelta(days=1)), board.now)


def alerts_by_line(spark, sf_dir):
    board = Board(spark, sf_dir)
    return rollups.alerts_by_line(board.alerts(board.now - timedelta(days=1)), board.now)


def open_alert_count(spark, sf_dir):
    return serving.open_alert_count(Board(spark, sf_dir).alerts())


def mtbf_by_line(spark, sf_dir):
    board = Board(spark, sf_dir)
    return rollups.failure_gaps(board.alerts(board.now - timedelta(days=7)), board.now)


# --- dashboard panels --------------------------------------------------------


def current_oee(spark, sf_dir):
    return serving.current_oee(Board(spark, sf_dir).newest_metrics())


def current_oee_class(spark, sf_dir):
    return serving.current_oee_class(Board(spark, sf_dir).newest_metrics())


def _rate_trend(value: str) -> Query:
    def query(spark, sf_dir):
        board = Board(spark, sf_dir)
        start = board.now - timedelta(hours=3)
        return serving.trend(board.metrics(start, board.now), value, factor=100, start=start, end=board.now)

    return query


def _stat_trend(value: str) -> Query:
    def query(spark, sf_dir):
        board = Board(spark, sf_dir)
        start = board.now - timedelta(hours=2)
        return serving.trend(board.stats(start, board.now), value, start=start, end=board.now)

    return query


def oee_trend_wide(spark, sf_dir):
    series = serving.trend(Board(spark, sf_dir).metrics(), "oee", factor=100)
    return serving.wide(series, "oee", [line[0] for line in schemas.LINES])


def active_alerts(spark, sf_dir):
    return serving.active_alerts(Board(spark, sf_dir).alerts())


def current_cpk(spark, sf_dir):
    return serving.current_cpk(Board(spark, sf_dir).newest_stats())


def hourly_oee_trend(spark, sf_dir):
    return serving.hourly_trend(Board(spark, sf_dir).hourly())


def worst_windows(spark, sf_dir):
    return serving.worst_windows(Board(spark, sf_dir).worst_metrics(20))


def recent_oee_trend(spark, sf_dir):
    board = Board(spark, sf_dir)
    return serving.recent_trend(board.metrics(board.now - timedelta(minutes=5)), board.now)


def low_oee_lines(spark, sf_dir):
    board = Board(spark, sf_dir)
    return rollups.low_oee_lines(board.metrics(board.now - timedelta(hours=1)), board.now)


def alerts_by_severity(spark, sf_dir):
    return serving.alerts_by_severity(Board(spark, sf_dir).alerts())


# --- shifts, statuses and quality on the full calendar -----------------------


def oee_by_shift(spark, sf_dir):
    return enrich.oee_by_shift(_calendar(spark, sf_dir).line_events)


def last_three_shifts(spark, sf_dir):
    return enrich.last_shifts(enrich.oee_by_shift(_calendar(spark, sf_dir).line_events))


def current_day_average(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return rollups.average_by_line(plant.metrics, F.date_trunc("DAY", plant.now))


def availability_heatmap(spark, sf_dir):
    return rollups.availability_heatmap(_calendar(spark, sf_dir).metrics)


def daily_quality(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return rollups.daily_quality(plant.line_events, plant.now)


def batch_quality_mismatches(spark, sf_dir):
    return enrich.quality_mismatches(Plant(spark, sf_dir).quality_metrics)


def planned_downtime_split(spark, sf_dir):
    return enrich.planned_downtime_split(Plant(spark, sf_dir).equipment_status)


def downtime_seconds_split(spark, sf_dir):
    return enrich.downtime_seconds_split(Plant(spark, sf_dir).line_events)


def fault_rate_by_context(spark, sf_dir):
    return enrich.fault_rate_by_context(_calendar(spark, sf_dir).equipment_status)


def fault_bursts(spark, sf_dir):
    return bursts.fault_bursts(Plant(spark, sf_dir).equipment_status)


def fault_rate_by_burst(spark, sf_dir):
    return bursts.fault_rate_by_burst(Plant(spark, sf_dir).equipment_status)


def status_intervals(spark, sf_dir):
    return intervals.status_intervals(_calendar(spark, sf_dir).equipment_status)


def mttr_by_line(spark, sf_dir):
    return intervals.repair_time_by_line(status_intervals(spark, sf_dir))


def repair_against_expected(spark, sf_dir):
    status = _calendar(spark, sf_dir).equipment_status
    return enrich.repair_against_expected(
        intervals.status_intervals(status, carry=("downtime_reason",))
    )


def invalid_fault_codes(spark, sf_dir):
    return enrich.invalid_fault_codes(Plant(spark, sf_dir).equipment_status)


def domain_violations(spark, sf_dir):
    plant = Plant(spark, sf_dir)
    reports = [enrich.domain_violations(getattr(plant, t), t) for t in schemas.DOMAINS]
    return reduce(DataFrame.unionByName, reports)


def six_big_losses(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return losses.six_big_losses(plant.line_events, plant.equipment_status)


def downtime_reasons(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return rollups.downtime_reasons(plant.equipment_status, plant.now)


def faults_per_hour(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return rollups.faults_per_hour(plant.equipment_status, plant.now)


def defect_types(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return rollups.defect_types(plant.quality_metrics, plant.now)


def shift_yield(spark, sf_dir):
    plant = _calendar(spark, sf_dir)
    return charts.shift_yield(plant.quality_metrics, plant.now)


def cpk_against_limits(spark, sf_dir):
    return charts.cpk_against_limits(Plant(spark, sf_dir).stats)


def defect_rate_chart(spark, sf_dir):
    return charts.defect_rate_chart(Plant(spark, sf_dir).quality_metrics)


def xbar_chart(spark, sf_dir):
    return charts.xbar_chart(Plant(spark, sf_dir).quality_metrics)


def ingest_latency(spark, sf_dir):
    return rollups.ingest_latency(Plant(spark, sf_dir).line_events)


def ingest_latency_sketched(spark, sf_dir):
    """Percentiles from stored sketches of hours, and whether their true ranks are within one percent."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "latency-sketches")
    rollups.latency_sketches(plant.line_events).write.parquet(path)
    found = rollups.latency_from_sketches(plant.spark.read.parquet(path))
    ms = F.expr("(unix_micros(ingested_at) - unix_micros(ts)) div 1000")
    wanted = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    # the share below a value and the share up to it enclose its rank
    ranks = plant.line_events.select(ms.alias("ms")).join(F.broadcast(found)).groupBy("events")
    below = {c: F.avg((F.col("ms") < F.col(c)).cast("int")) for c in wanted}
    up_to = {c: F.avg((F.col("ms") <= F.col(c)).cast("int")) for c in wanted}
    good = [((below[c] <= p + 0.01) & (up_to[c] >= p - 0.01)).alias(f"{c[:3]}_within") for c, p in wanted.items()]
    return ranks.agg(*good)


def sensor_trend(spark, sf_dir):
    return rollups.sensor_trend(Plant(spark, sf_dir).equipment_status)


# --- reading and decoding ----------------------------------------------------


def cycle_scan(spark, sf_dir):
    return (
        Plant(spark, sf_dir)
        .line_events.filter(F.col("event_type") == schemas.CYCLE)
        .select("event_id", "line_id", "units_produced", "units_rejected")
    )


def as_messages(rows: DataFrame, columns: list[str], tag: Column) -> DataFrame:
    """Rows as JSON messages the way a careless producer sends them.

    ``tag`` varies them: some are cut off, some carry their numbers as text,
    some lack the line.
    """
    line = F.when(tag % 7 != 0, F.col("line_id")).alias("line_id")
    own = [iso_time(F.col("ts")).alias("timestamp"), line]
    typed = F.to_json(F.struct(*own, *columns))
    text = F.to_json(F.struct(*own, *[F.col(c).cast("string").alias(c) for c in columns]))
    whole = F.when(tag % 2 == 0, typed).otherwise(text)
    return rows.select(
        F.when(tag % 13 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("payload")
    )


def _decoded(table: str, columns: list[str], tag: str) -> Query:
    def query(spark, sf_dir):
        rows = getattr(Plant(spark, sf_dir), table)
        messages = as_messages(rows, ["event_id", *columns], F.col(tag))
        decoded = feeds.with_defaults(feeds.decode(messages, table), table)
        return decoded.select("event_id", "ts", "line_id", "schema_version", *columns)

    return query


def decode_rejects(spark, sf_dir):
    """Messages that enter no window, by line and reason; some are sent without their time, some with a broken one."""
    tag = F.col("event_id")
    stamp = F.when(tag % 11 == 0, None).when(tag % 17 == 0, "yesterday").otherwise(iso_time(F.col("ts")))
    whole = F.to_json(F.struct(stamp.alias("timestamp"), "line_id", "units_produced"))
    sent = Plant(spark, sf_dir).line_events.select(
        F.when(tag % 13 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("payload")
    )
    line = F.coalesce(F.get_json_object("payload", "$.line_id"), F.lit("-"))
    found = feeds.rejects(sent, "line_events")
    return found.groupBy(line.alias("line_id"), "reason").agg(F.count(F.lit(1)).alias("messages"))


# --- metric tables, alerts and the archive -----------------------------------


def upsert_oee_metrics(spark, sf_dir):
    """Inserts all windows with a shorter planned time, then overwrites them batch by batch."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "oee-metrics")
    tables.upsert_oee_metrics(path, oee.oee_by_window(plant.line_events, planned_time_s=1800), batch=0)
    final = plant.metrics
    for batch in (1, 1, 2):
        part = final.filter(F.hour("time") % 2 == batch - 1)
        tables.upsert_oee_metrics(path, part, batch=batch)
    return tables.read_table(spark, path, schemas.OEE_METRICS).drop(tables.HOUR)


def upsert_quality_stats(spark, sf_dir):
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "quality-stats")
    for batch in (0, 1):
        tables.upsert_quality_stats(path, plant.stats, batch=batch)
    return tables.read_table(spark, path, schemas.QUALITY_STATS).drop(tables.HOUR)


def append_alerts(spark, sf_dir):
    """Appends the alerts in two batches, the second of them twice."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "alerts")
    late = F.hour("timestamp") > 0
    tables.append_alerts(path, plant.alerts.filter(~late), batch=0, run="r")
    for _ in range(2):
        tables.append_alerts(path, plant.alerts.filter(late), batch=1, run="r")
    return tables.read_alerts(spark, path).drop("id", "created_at", "alert_date", "run", "batch")


def upsert_after_restart(spark, sf_dir):
    """Two runs whose batches have the same numbers, and a repetition of the first; the odd minutes come second."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "oee-restart")
    for rest in (0, 1, 0):
        part = plant.metrics.filter(F.minute("time") % 2 == rest)
        tables.upsert_oee_metrics(path, part, batch=0)
    return tables.read_table(spark, path, schemas.OEE_METRICS).drop(tables.HOUR)


def alerts_after_restart(spark, sf_dir):
    """Two runs append their alerts, both as batch 0, the second twice."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "alerts-restart")
    odd = F.minute("timestamp") % 2 == 1
    for run, part in (("first", ~odd), ("second", odd), ("second", odd)):
        tables.append_alerts(path, plant.alerts.filter(part), batch=0, run=run)
    return tables.read_alerts(spark, path).drop("id", "created_at", "alert_date", "run", "batch")


def hot_retention(spark, sf_dir):
    """Stores a month of windows and keeps the last seven days, by whole hours."""
    plant = _calendar(spark, sf_dir)
    path = scratch_path(plant.spark, "retention")
    hourly = oee.oee_by_window(plant.line_events, window="1 hour")
    tables.upsert_oee_metrics(path, hourly, batch=0)
    tables.apply_retention(spark, path, datetime(2024, 1, 31, 0, 30))
    return tables.read_table(spark, path, schemas.OEE_METRICS).drop(tables.HOUR)


def hourly_rollup_table(spark, sf_dir):
    """A stored rollup after a full load and two scheduled refreshes."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(plant.spark, "oee-hourly")
    metrics = plant.metrics
    tables.upsert_hourly(path, rollups.oee_hourly(metrics), batch=0)
    for batch in (1, 2):
        tables.upsert_hourly(path, rollups.refreshed_hours(metrics, plant.now), batch=batch)
    return tables.read_hourly(spark, path)


def oee_refresh_changed(spark, sf_dir):
    """A rollup brought up to date twice: after a first load, and after rows for old hours came late."""
    plant = Plant(spark, sf_dir)
    root = scratch_path(plant.spark, "oee-changed")
    later = datetime(2100, 1, 1)
    late = F.minute("time") % 7 == 0
    for batch, part in enumerate((plant.metrics.filter(~late), plant.metrics.filter(late))):
        tables.upsert_oee_metrics(f"{root}/oee", part, batch=batch)
        tables.refresh_changed(plant.spark, f"{root}/oee", f"{root}/hourly", later, batch=batch)
    return tables.read_hourly(plant.spark, f"{root}/hourly")


def _archive(spark: SparkSession, sf_dir: str) -> str:
    """An archive of the three event tables, ten days per snapshot."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _ARCHIVES and folders.exists(spark, _ARCHIVES[key]):
        return _ARCHIVES[key]
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive")
    archive.ensure_tables(spark, root)
    bounds = [F.lit(b).cast("timestamp") for b in _SNAPSHOT_BOUNDS]
    for table in schemas.EVENT_TABLES:
        rows = getattr(plant, table)
        for number in range(1, len(bounds) + 2):
            part = rows
            if number > 1:
                part = part.filter(F.col("ts") >= bounds[number - 2])
            if number <= len(bounds):
                part = part.filter(F.col("ts") < bounds[number - 1])
            archive.append_snapshot(
                root, table, part, number, run="r", committed_at=F.lit(f"2024-02-0{number} 00:00:00").cast("timestamp")
            )
    _ARCHIVES[key] = root
    return root


def archive_tables(spark, sf_dir):
    return archive.list_tables(spark, _archive(spark, sf_dir))


def archive_snapshots(spark, sf_dir):
    return archive.snapshots(spark, _archive(spark, sf_dir), "line_events")


_SHOWN = ["event_id", "ts", "line_id", "event_type", "units_produced", "snapshot_id"]


def archive_scan(spark, sf_dir):
    return archive.scan(spark, _archive(spark, sf_dir), "line_events").select(*_SHOWN)


def archive_scan_as_of_snapshot(spark, sf_dir):
    return archive.scan(
        spark, _archive(spark, sf_dir), "line_events", as_of_snapshot=2
    ).select(*_SHOWN)


def archive_scan_as_of_time(spark, sf_dir):
    return archive.scan(
        spark, _archive(spark, sf_dir), "line_events", as_of_time=datetime(2024, 2, 1, 12)
    ).select(*_SHOWN)


def archive_row_counts(spark, sf_dir):
    root = _archive(spark, sf_dir)
    counts = [
        archive.scan(spark, root, "quality_metrics", as_of_snapshot=n).agg(
            F.lit(n).alias("as_of_snapshot"), F.count(F.lit(1)).alias("rows")
        )
        for n in (1, 2, 3)
    ]
    return reduce(DataFrame.unionByName, counts)


def archive_day_scan(spark, sf_dir):
    """One line on one day: all other partitions are pruned."""
    day = F.col("event_date") == F.lit("2024-01-15").cast("date")
    return archive.scan(
        spark, _archive(spark, sf_dir), "line_events", where=day & (F.col("line_id") == "LINE-B")
    ).select(*_SHOWN)


def archive_quality_summary(spark, sf_dir):
    return rollups.production_quality(archive.scan(spark, _archive(spark, sf_dir), "line_events"))


def archive_oee_as_of(spark, sf_dir):
    """Effectiveness per hour as the archive knew it after its second snapshot."""
    rows = archive.scan(spark, _archive(spark, sf_dir), "line_events", as_of_snapshot=2)
    return oee.oee_by_window(rows, window="1 hour")


def archive_daily_quality(spark, sf_dir):
    """Thirty days of daily quality from the archive; older days are pruned."""
    as_of = datetime(2024, 2, 5)
    rows = archive.scan(
        spark, _archive(spark, sf_dir), "line_events", since=as_of - timedelta(days=30), until=as_of
    )
    return rollups.daily_quality(rows, as_of)


def archive_added_column(spark, sf_dir):
    """A column added between two snapshots; older rows read as null."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "evolution")
    change = F.lit(_SNAPSHOT_BOUNDS[0]).cast("timestamp")
    archive.append_snapshot(root, "line_events", plant.line_events.filter(F.col("ts") < change), 1, run="r")
    later = plant.line_events.filter(F.col("ts") >= change)
    named = later.withColumn("operator_id", F.concat(F.lit("OP-"), F.col("work_unit_id")))
    archive.append_snapshot(root, "line_events", named, 2, run="r", extra=_OPERATOR_ID)
    rows = archive.scan(spark, root, "line_events", extra=_OPERATOR_ID)
    return rows.groupBy("operator_id", "snapshot_id").agg(F.count(F.lit(1)).alias("rows"))


def archive_retention(spark, sf_dir):
    """Quality batches left after keeping the last twenty days."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive-retention")
    archive.append_snapshot(root, "quality_metrics", plant.quality_metrics, 1, run="r")
    archive.apply_archive_retention(spark, root, "quality_metrics", datetime(2024, 1, 31), 20)
    left = archive.scan(spark, root, "quality_metrics")
    return left.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("batches"), F.min("event_date").cast("string").alias("first_day")
    )


def archive_after_restart(spark, sf_dir):
    """Two runs archive different rows, both as batch 0, the first twice; each keeps its own snapshot."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive-restart")
    late = F.col("ts") >= F.lit(_SNAPSHOT_BOUNDS[0]).cast("timestamp")
    for run, part in (("first", ~late), ("second", late), ("first", ~late)):
        archive.append_snapshot(root, "line_events", plant.line_events.filter(part), 0, run=run)
    return archive.scan(spark, root, "line_events").select(*_SHOWN)


def archive_gap(spark, sf_dir):
    """Rows per snapshot after the entry of the second of three has been lost from the log."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive-gap")
    for number in range(3):
        part = plant.line_events.filter(F.dayofmonth("ts") % 3 == number)
        archive.append_snapshot(root, "line_events", part, number, run="r")
    log = f"{root}/line_events/snapshots"
    folders.drop(spark, f"{log}/snapshot={folders.partition_values(spark, log, 'snapshot')[1]}")
    rows = archive.scan(spark, root, "line_events")
    return rows.groupBy("snapshot_id", "line_id").agg(F.count(F.lit(1)).alias("rows"))


def archive_tables_after_retention(spark, sf_dir):
    """The listing after all days but the last twenty were dropped from one table."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive-listing")
    for table in schemas.EVENT_TABLES:
        archive.append_snapshot(root, table, getattr(plant, table), 1, run="r")
    archive.apply_archive_retention(spark, root, "quality_metrics", datetime(2024, 1, 31), 20)
    return archive.list_tables(spark, root)


def _compacted(spark: SparkSession, sf_dir: str) -> str:
    """Line events of a month: two snapshots compacted up to a day, then late rows for all days."""
    plant = _calendar(spark, sf_dir)
    root = scratch_path(spark, "archive-compacted")
    for number in range(3):
        if number == 2:
            compaction.compact_days(spark, root, "line_events", datetime(2024, 1, 21))
        part = plant.line_events.filter(F.minute("ts") % 3 == number)
        archive.append_snapshot(root, "line_events", part, number + 1, run="r")
    return root


def archive_compacted(spark, sf_dir):
    """Snapshots stay apart in compacted days, and late rows for such days are found."""
    root = _compacted(spark, sf_dir)
    parts = [
        archive.scan(spark, root, "line_events", as_of_snapshot=n).select(F.lit(n).alias("as_of"), *_SHOWN) for n in (2, 3)
    ]
    return parts[0].unionByName(parts[1])


def archive_compacted_twice(spark, sf_dir):
    """The same rows after the late ones were taken into the compacted days."""
    root = _compacted(spark, sf_dir)
    compaction.compact_days(spark, root, "line_events", datetime(2024, 1, 26))
    return archive.scan(spark, root, "line_events").select(*_SHOWN)


def archive_point_lookup(spark, sf_dir):
    """One work unit's rows of compacted days: sorted files with statistics and Bloom filters skip the others."""
    root = _compacted(spark, sf_dir)
    rows = archive.scan(
        spark, root, "line_events", until=datetime(2024, 1, 20, 23, 59, 59), where=F.col("work_unit_id") == "WU-01"
    )
    return rows.select("work_unit_id", *_SHOWN)


def archive_first_rows(spark, sf_dir):
    """A limited scan: as many rows as asked for, all of them of the table."""
    rows = archive.scan(spark, _archive(spark, sf_dir), "line_events", limit=100)
    known = archive.scan(spark, _archive(spark, sf_dir), "line_events").select("event_id").distinct()
    return rows.join(known, "event_id").agg(F.count(F.lit(1)).alias("rows"))


# --- streaming ---------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.file_feed(spark, sf_dir, plant_views.EVENT_LOG, pathGlobFilter="events.parquet")


def _finish(query) -> None:
    query.awaitTermination()


def stream_oee(spark, sf_dir):
    """Windows closed by the watermark, through the upsert sink."""
    use_utc(spark)
    path = scratch_path(spark, "stream-oee")
    events = plant_views.line_events(_event_stream(spark, sf_dir))
    _finish(jobs.run_oee(events, f"{path}/table", f"{path}/checkpoint", once=True))
    return tables.read_table(spark, f"{path}/table", schemas.OEE_METRICS).drop(tables.HOUR)


def stream_cpk(spark, sf_dir):
    use_utc(spark)
    path = scratch_path(spark, "stream-cpk")
    batches = plant_views.quality_metrics(_event_stream(spark, sf_dir))
    _finish(jobs.run_cpk(batches, f"{path}/table", f"{path}/checkpoint", once=True))
    return tables.read_table(spark, f"{path}/table", schemas.QUALITY_STATS).drop(tables.HOUR)


def stream_precursors(spark, sf_dir):
    use_utc(spark)
    path = scratch_path(spark, "stream-alerts")
    status = plant_views.equipment_status(_event_stream(spark, sf_dir))
    _finish(jobs.run_alerts(status, f"{path}/table", f"{path}/checkpoint", once=True))
    return tables.read_alerts(spark, f"{path}/table").drop("id", "created_at", "alert_date", "run", "batch")


def _finished(spark, sf_dir, start, view, label, pace=plant_views.DENSE):
    """Runs a job over the whole feed and closes it an hour after its newest event."""
    use_utc(spark)
    path = scratch_path(spark, label)
    newest = Plant(spark, sf_dir, pace).line_events.agg(F.unix_micros(F.max("ts"))).first()[0] or 0
    at = datetime(1970, 1, 1) + timedelta(microseconds=newest, hours=1)

    def again():
        rows = view(_event_stream(spark, sf_dir), pace)
        return start(rows, f"{path}/table", f"{path}/checkpoint", heartbeat=f"{path}/beats", once=True)

    jobs.finish(again, spark, f"{path}/beats", at)
    return f"{path}/table"


def stream_oee_finished(spark, sf_dir):
    """All windows of a feed that has ended."""
    path = _finished(spark, sf_dir, jobs.run_oee, plant_views.line_events, "finish-oee")
    return tables.read_table(spark, path, schemas.OEE_METRICS).drop(tables.HOUR)


def stream_cpk_finished(spark, sf_dir):
    path = _finished(spark, sf_dir, jobs.run_cpk, plant_views.quality_metrics, "finish-cpk")
    return tables.read_table(spark, path, schemas.QUALITY_STATS).drop(tables.HOUR)


def stream_precursors_finished(spark, sf_dir):
    path = _finished(spark, sf_dir, jobs.run_alerts, plant_views.equipment_status, "finish-alerts")
    return tables.read_alerts(spark, path).drop("id", "created_at", "alert_date", "run", "batch")


def stream_status_intervals(spark, sf_dir):
    """Finished intervals of a whole month, from a stream."""
    path = _finished(spark, sf_dir, jobs.run_intervals, plant_views.equipment_status, "finish-intervals", pace=1)
    return spark.read.parquet(path).drop("run", "batch")


def stream_fault_bursts(spark, sf_dir):
    """Bursts of a feed that has ended."""

    def start(status, path, checkpoint, *, heartbeat, once):
        return jobs.run_bursts(status, path, checkpoint, heartbeat=heartbeat, once=once)

    path = _finished(spark, sf_dir, start, plant_views.equipment_status, "finish-bursts")
    return spark.read.parquet(path).drop("run", "batch")


def stream_progress(spark, sf_dir):
    """What the log keeps of a finished effectiveness job: all rows are counted, and every batch is timed."""
    path = scratch_path(spark, "progress")
    with progress.ProgressLog(spark, path):
        _finished(spark, sf_dir, partial(jobs.run_oee, name="oee"), plant_views.line_events, "finish-progress")
    report = progress.progress_report(progress.read_progress(spark, path))
    timed = [F.col(f"{c}_p50_ms") <= F.col(f"{c}_p95_ms") for c in ("batch", "checkpoint")]
    return report.select("query", "rows_in", "late_rows", (timed[0] & timed[1]).alias("timed"))


def stream_topic_oee(spark, sf_dir):
    """Windows of events that arrive as JSON messages of a topic, in two deliveries."""
    plant = Plant(spark, sf_dir)
    path = scratch_path(spark, "topic")
    columns = ["event_id", "line_id", "event_type", "units_produced", "units_rejected", "downtime_s", "ideal_cycle_time_ms"]
    sent = plant.line_events.select(
        F.to_json(F.struct(iso_time(F.col("ts")).alias("timestamp"), *columns)).alias("value"), "ts"
    )
    newest = Board(spark, sf_dir).now
    half = newest - timedelta(hours=1)
    for number, part in enumerate((sent.filter(F.col("ts") < F.lit(half)), sent.filter(F.col("ts") >= F.lit(half)))):
        part.select("value").write.text(f"{path}/topic/delivery={number}")

        def again():
            messages = feeds.with_defaults(feeds.decode(message_log.message_feed(spark, f"{path}/topic"), "line_events"), "line_events")
            return jobs.run_oee(messages, f"{path}/table", f"{path}/checkpoint", heartbeat=f"{path}/beats", once=True)

        again().awaitTermination()
    jobs.finish(again, spark, f"{path}/beats", newest + timedelta(hours=1), one_batch_runs=True)
    return tables.read_table(spark, f"{path}/table", schemas.OEE_METRICS).drop(tables.HOUR)


def _replayed(start, view, label: str) -> Callable[[SparkSession, str], str]:
    """Runs a job over a feed that delivers every event, then every third one again, and closes it."""

    def run(spark, sf_dir):
        plant = Plant(spark, sf_dir)
        path = scratch_path(spark, label)
        # the second delivery holds repetitions within the delay and ones that are far too late
        for number, part in enumerate((plant.events, plant.events.filter(F.col("event_id") % 3 == 0))):
            part.unionByName(part.filter(F.col("event_id") % 2 == 0)).coalesce(1).write.parquet(f"{path}/in/part={number}")
        at = Board(spark, sf_dir).now + timedelta(hours=1)

        def again():
            feed = feeds.file_feed(
                spark, f"{path}/in", plant_views.EVENT_LOG, recursiveFileLookup="true", maxFilesPerTrigger="1"
            )
            return start(
                view(feed), f"{path}/table", f"{path}/checkpoint", heartbeat=f"{path}/beats", distinct=True, once=True
            )

        jobs.finish(again, spark, f"{path}/beats", at)
        return f"{path}/table"

    return run


def stream_oee_deduplicated(spark, sf_dir):
    path = _replayed(jobs.run_oee, plant_views.line_events, "distinct-oee")(spark, sf_dir)
    return tables.read_table(spark, path, schemas.OEE_METRICS).drop(tables.HOUR)


def stream_cpk_deduplicated(spark, sf_dir):
    path = _replayed(jobs.run_cpk, plant_views.quality_metrics, "distinct-cpk")(spark, sf_dir)
    return tables.read_table(spark, path, schemas.QUALITY_STATS).drop(tables.HOUR)


def stream_precursors_deduplicated(spark, sf_dir):
    path = _replayed(jobs.run_alerts, plant_views.equipment_status, "distinct-alerts")(spark, sf_dir)
    return tables.read_alerts(spark, path).drop("id", "created_at", "alert_date", "run", "batch")


def stream_archive(spark, sf_dir):
    use_utc(spark)
    path = scratch_path(spark, "stream-archive")
    for table in schemas.EVENT_TABLES:
        events = getattr(plant_views, table)(_event_stream(spark, sf_dir))
        _finish(
            jobs.run_archive(events, f"{path}/archive", table, f"{path}/checkpoint/{table}", once=True)
        )
    return archive.list_tables(spark, f"{path}/archive")


_NAMED: tuple[Query, ...] = (
    oee_by_window,
    oee_by_hour_window,
    oee_fault_downtime_only,
    rolling_cpk,
    rolling_cpk_fine,
    fault_precursors,
    oee_against_target,
    oee_hourly_rollup,
    oee_hourly_refresh,
    daily_oee,
    alerts_per_hour,
    alerts_last_day,
    alerts_by_line,
    open_alert_count,
    mtbf_by_line,
    current_oee,
    current_oee_class,
    oee_trend_wide,
    active_alerts,
    current_cpk,
    hourly_oee_trend,
    worst_windows,
    recent_oee_trend,
    low_oee_lines,
    alerts_by_severity,
    oee_by_shift,
    last_three_shifts,
    current_day_average,
    availability_heatmap,
    daily_quality,
    batch_quality_mismatches,
    planned_downtime_split,
    downtime_seconds_split,
    fault_rate_by_context,
    fault_bursts,
    fault_rate_by_burst,
    status_intervals,
    mttr_by_line,
    repair_against_expected,
    invalid_fault_codes,
    domain_violations,
    six_big_losses,
    downtime_reasons,
    faults_per_hour,
    defect_types,
    shift_yield,
    cpk_against_limits,
    defect_rate_chart,
    xbar_chart,
    ingest_latency,
    ingest_latency_sketched,
    sensor_trend,
    cycle_scan,
    decode_rejects,
    upsert_oee_metrics,
    upsert_quality_stats,
    append_alerts,
    upsert_after_restart,
    alerts_after_restart,
    archive_after_restart,
    archive_gap,
    archive_tables_after_retention,
    archive_first_rows,
    archive_compacted,
    archive_compacted_twice,
    archive_point_lookup,
    hot_retention,
    hourly_rollup_table,
    oee_refresh_changed,
    archive_tables,
    archive_snapshots,
    archive_scan,
    archive_scan_as_of_snapshot,
    archive_scan_as_of_time,
    archive_row_counts,
    archive_day_scan,
    archive_quality_summary,
    archive_oee_as_of,
    archive_daily_quality,
    archive_added_column,
    archive_retention,
    stream_oee,
    stream_cpk,
    stream_precursors,
    stream_oee_finished,
    stream_cpk_finished,
    stream_precursors_finished,
    stream_status_intervals,
    stream_fault_bursts,
    stream_topic_oee,
    stream_progress,
    stream_oee_deduplicated,
    stream_cpk_deduplicated,
    stream_precursors_deduplicated,
    stream_archive,
)

LINE_COLUMNS = ["work_unit_id", "event_type", "units_produced", "units_rejected", "downtime_s"]
STATUS_COLUMNS = [
    "equipment_id",
    "status",
    "previous_status",
    "downtime_reason",
    "planned_downtime",
    "temperature_c",
    "vibration_hz",
    "fault_code",
]
QUALITY_COLUMNS = ["batch_id", "units_inspected", "units_failed", "measured_mean", "spec_upper", "cpk"]


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {query.__name__: query for query in _NAMED}
    for value in ("oee", "availability", "performance", "quality"):
        found[f"{value}_trend"] = _rate_trend(value)
    for value in ("rolling_cpk", "rolling_mean", "rolling_stddev"):
        found[f"{value}_trend"] = _stat_trend(value)
    found["decode_line_events"] = _decoded("line_events", LINE_COLUMNS, "downtime_s")
    found["decode_equipment_status"] = _decoded("equipment_status", STATUS_COLUMNS, "event_id")
    found["decode_quality_metrics"] = _decoded("quality_metrics", QUALITY_COLUMNS, "units_inspected")

    def plain(query: Query) -> Query:
        return lambda spark, sf_dir: _plain(query(use_utc(spark), sf_dir))

    return {name: plain(query) for name, query in found.items()}
