"""Metric tables with upsert, the alert table, and retention.

Metric tables are Parquet, partitioned by the hour of ``time``, and have one
writer at a time. An upsert rewrites only the hours it touches. Its result is
first written to a staging folder of its own and only then published into the
table. A driver that dies while publishing leaves that copy behind, and the
next upsert, whosever it is, publishes it before it reads the table. So no
copy is ever published over rows that were not in the table when it was made.

Beside a table lie a summary of each hour, one row per line, by which readers
that want the newest or the smallest rows choose the hours to open, and, for
the table that has a rollup, one empty file per published change of an hour,
by which the rollup knows what to compute again. Both are written before the staged copy goes, so a lost driver
leaves neither behind the table. Readers see the hours of one publication
appear one after the other.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.clock import in_utc, instant
from millwright.operators.rollups import oee_hourly, refreshed_hours
from millwright.sinks import folders

HOUR = "hour"
_HOUR_FORMAT = "yyyy-MM-dd-HH"
KEYS = ("time", "line_id")
_HOURLY = T.StructType([T.StructField("time", T.TimestampType())] + schemas.OEE_HOURLY.fields[1:])


def hour_of(ts: Column) -> Column:
    return F.date_format(ts, _HOUR_FORMAT)


def fit(rows: DataFrame, layout: T.StructType, *keep: str) -> DataFrame:
    """Columns in the table's types; a figure that does not fit becomes null.

    Under the observation name ``fit`` the query reports how many rows had such
    a figure, instead of failing the whole write for one outlier.
    """
    cast = {f.name: F.col(f.name).try_cast(f.dataType.simpleString()) for f in layout.fields}
    lost = F.lit(False)
    for name, value in cast.items():
        lost = lost | (F.col(name).isNotNull() & value.isNull())
    return rows.observe(
        "fit", F.count(F.lit(1)).alias("rows"), F.count(F.when(lost, 1)).alias("misfits")
    ).select(*[value.alias(name) for name, value in cast.items()], *keep)


def create_if_missing(spark: SparkSession, path: str, layout: T.StructType) -> bool:
    """Writes an empty table if there is none yet; True if it was created."""
    if folders.has_data(spark, path):
        return False
    spark.createDataFrame([], layout).write.mode("ignore").parquet(path)
    return True


def _stored(layout: T.StructType) -> T.StructType:
    return T.StructType(layout.fields + [T.StructField(HOUR, T.StringType())])


def read_table(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A metric table; a time filter on the result should go through ``in_hours``."""
    if not folders.has_data(spark, path):
        return spark.createDataFrame([], _stored(layout))
    return spark.read.schema(_stored(layout)).parquet(path)


def in_hours(table: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows of a closed time range; hour partitions outside it are pruned before they are read."""
    for bound, keep in ((start, lambda c, b: c >= b), (end, lambda c, b: c <= b)):
        if bound is not None:
            table = table.filter(
                keep(F.col(HOUR), F.lit(in_utc(bound).strftime("%Y-%m-%d-%H"))) & keep(F.col("time"), instant(bound))
            )
    return table


def latest_per_key(rows: DataFrame, keys: tuple[str, ...], version: str | None = None) -> DataFrame:
    """One row per key: the one with the highest version, or else the largest row.

    An aggregate rather than a ranking: copies of one key collapse on the map
    side, however many there are.
    """
    values = [c for c in rows.columns if c not in keys and c != version]
    whole = F.struct(*values)
    newest = F.max(whole) if version is None else F.max_by(whole, F.struct(version, *values))
    return rows.groupBy(*keys).agg(newest.alias("row")).select(*keys, *[f"row.{c}" for c in values])


def upsert(
    path: str,
    updates: DataFrame,
    layout: T.StructType,
    *,
    batch: str | int,
    keys: tuple[str, ...] = KEYS,
    version: str | None = None,
) -> None:
    """Inserts rows or overwrites those with the same key.

    ``version`` names the column that decides between several updates of one
    key. Repeating a batch leaves the table as it was; ``batch`` only labels
    the staged copy.

    The updates are computed once, into the staging folder. The hours they
    touch are taken from there, and of the table only those are read.
    """
    spark = updates.sparkSession
    finish_interrupted(spark, path, layout)
    staged = f"{path}__staged/batch={batch}-{uuid.uuid4().hex}"
    keep = () if version is None else (version,)
    latest_per_key(fit(updates, layout, *keep), keys, version).filter(F.col("time").isNotNull()).withColumn(
        HOUR, hour_of(F.col("time"))
    ).write.parquet(f"{staged}/fresh")
    columns = [f.name for f in layout.fields] + [HOUR]
    fresh = spark.read.schema(_stored(layout)).parquet(f"{staged}/fresh").select(*columns)
    hours = _hours(fresh)
    if hours:
        present = sorted(set(folders.partition_values(spark, path, HOUR)).intersection(hours))
        merged = fresh
        if present:
            current = _read_hours(spark, path, layout, present).select(*columns)
            kept = current.join(fresh.select(*keys), list(keys), "left_anti").select(*columns)
            merged = kept.unionByName(fresh)
        merged.write.parquet(f"{staged}/merged")
        publish(spark, f"{staged}/merged", path, layout)
    folders.drop(spark, staged)


def finish_interrupted(spark: SparkSession, path: str, layout: T.StructType) -> None:
    """Publishes a complete staged copy that a lost driver left behind; drops an incomplete one."""
    for name in folders.names(spark, f"{path}__staged"):
        staged = f"{path}__staged/{name}"
        if folders.exists(spark, f"{staged}/merged/_SUCCESS"):
            publish(spark, f"{staged}/merged", path, layout)
        folders.drop(spark, staged)


def _hours(rows: DataFrame) -> list[str]:
    """Names of the hour partitions some rows belong to: one per folder to be written."""
    return [row[0] for row in rows.select(HOUR).distinct().collect()]


def _read_hours(spark: SparkSession, path: str, layout: T.StructType, present: list[str]) -> DataFrame:
    """Hour partitions of a table that exist; no other is listed."""
    if not present:
        return spark.createDataFrame([], _stored(layout))
    return (
        spark.read.schema(_stored(layout)).option("basePath", path).parquet(*[f"{path}/{HOUR}={h}" for h in present])
    )


def read_between(
    spark: SparkSession, path: str, layout: T.StructType, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Rows of a closed time range. Of the table's folders only the hours in it are opened."""
    low, high = (None if t is None else in_utc(t).strftime("%Y-%m-%d-%H") for t in (start, end))
    present = [
        h
        for h in folders.partition_values(spark, path, HOUR)
        if (low is None or h >= low) and (high is None or h <= high)
    ]
    return in_hours(_read_hours(spark, path, layout, present), start, end)


def _numbers(layout: T.StructType) -> list[str]:
    return [f.name for f in layout.fields if isinstance(f.dataType, T.NumericType)]


def _summary(layout: T.StructType) -> T.StructType:
    kinds = {f.name: f.dataType for f in layout.fields}
    bounds = [T.StructField(f"{c}_{end}", kinds[c]) for c in _numbers(layout) for end in ("low", "high")]
    missing = [T.StructField(f"{c}_missing", T.LongType()) for c in _numbers(layout)]
    return T.StructType(
        [T.StructField("line_id", T.StringType()), T.StructField("rows", T.LongType())]
        + [T.StructField(end, T.TimestampType()) for end in ("first", "last")]
        + bounds + missing + [T.StructField(HOUR, T.StringType())]
    )


def summarized(rows: DataFrame, layout: T.StructType) -> DataFrame:
    """Per hour and line: how many rows, their times, and the range of every figure."""
    figures = []
    for c in _numbers(layout):
        figures += [F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"), (F.count(F.lit(1)) - F.count(c)).alias(f"{c}_missing")]
    found = rows.groupBy(HOUR, "line_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first"), F.max("time").alias("last"), *figures
    )
    return found.select(*_summary(layout).fieldNames())


def read_summary(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The summaries of the hours that the table still holds."""
    there = set(folders.partition_values(spark, path, HOUR))
    present = [h for h in folders.partition_values(spark, f"{path}__summary", HOUR) if h in there]
    if not present:
        return spark.createDataFrame([], _summary(layout))
    reader = spark.read.schema(_summary(layout)).option("basePath", f"{path}__summary")
    return reader.parquet(*[f"{path}__summary/{HOUR}={h}" for h in present])


def newest_of_lines(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The hours that hold the newest row of some line; no other hour is opened.

    A line's older hours cannot matter, so that a query for newest rows may
    read this in place of the table.
    """
    tops = read_summary(spark, path, layout).groupBy("line_id").agg(F.max(HOUR).alias(HOUR))
    # one folder name per line at most
    return _read_hours(spark, path, layout, sorted({row[HOUR] for row in tops.select(HOUR).distinct().collect()}))


def newest_hour(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The last hour of the table, which holds its newest time."""
    present = folders.partition_values(spark, path, HOUR)
    return _read_hours(spark, path, layout, present[-1:])


def smallest(
    spark: SparkSession, path: str, layout: T.StructType, column: str, k: int,
    start: datetime | None = None, end: datetime | None = None,
) -> DataFrame:
    """Hours that hold the ``k`` smallest values of a time range, nulls first, and all that tie with them.

    Hours are opened by rising lower bound, twice as many in each step, until
    the next bound lies above the worst value kept. The driver holds one row per
    hour of the table.
    """
    low, high = (None if t is None else in_utc(t).strftime("%Y-%m-%d-%H") for t in (start, end))
    within = read_summary(spark, path, layout)
    if low is not None:
        within = within.filter(F.col(HOUR) >= low)
    if high is not None:
        within = within.filter(F.col(HOUR) <= high)
    bounds = (
        within.groupBy(HOUR)
        .agg(F.min(f"{column}_low").alias("low"), F.sum(f"{column}_missing").alias("missing"))
        .orderBy((F.col("missing") == 0), "low", HOUR)
        .collect()
    )
    opened = 1
    while True:
        rows = in_hours(_read_hours(spark, path, layout, sorted(b[HOUR] for b in bounds[:opened])), start, end)
        if opened >= len(bounds):
            return rows
        kept = rows.select(column).orderBy(F.asc_nulls_first(column)).limit(k)
        held, worst = kept.agg(F.count(F.lit(1)), F.max(column)).first()
        # a full list of nulls has no worst value, and no further hour without nulls can matter
        following = bounds[opened]
        if held >= k and not following["missing"] and (worst is None or following["low"] > worst):
            return rows
        opened *= 2


def publish(spark: SparkSession, staged: str, path: str, layout: T.StructType) -> None:
    """Replaces the table's hour partitions that the staged copy contains."""
    columns = [f.name for f in layout.fields] + [HOUR]
    rows = spark.read.schema(_stored(layout)).parquet(staged).select(*columns)
    hours = _hours(rows)
    tasks = min(len(hours), spark.sparkContext.defaultParallelism)
    (
        rows.repartition(max(tasks, 1), HOUR)
        .sortWithinPartitions(HOUR, "line_id", "time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(HOUR)
        .parquet(path)
    )
    (
        summarized(rows, layout)
        .repartition(max(tasks, 1), HOUR)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(HOUR)
        .parquet(f"{path}__summary")
    )
    if folders.exists(spark, f"{path}__changed"):
        for hour in hours:
            folders.touch(spark, f"{path}__changed/{hour}.{uuid.uuid4().hex}")


def changed_hours(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Hours changed since they were last settled, with the entries that say so."""
    entries: dict[str, list[str]] = {}
    for name in folders.names(spark, f"{path}__changed"):
        entries.setdefault(name.split(".")[0], []).append(name)
    return entries


def settle(spark: SparkSession, path: str, entries: list[str]) -> None:
    """Takes back entries that have been acted on; later ones for the same hours stay."""
    for name in entries:
        folders.drop(spark, f"{path}__changed/{name}")


def upsert_oee_metrics(path: str, updates: DataFrame, *, batch: str | int) -> None:
    """Windows of effectiveness; changed hours are noted for the rollup."""
    folders.make(updates.sparkSession, f"{path}__changed")
    upsert(path, updates, schemas.OEE_METRICS, batch=batch)


def upsert_quality_stats(path: str, updates: DataFrame, *, batch: str | int) -> None:
    upsert(path, updates, schemas.QUALITY_STATS, batch=batch)


def upsert_hourly(path: str, updates: DataFrame, *, batch: str | int) -> None:
    """Hourly rollup rows, keyed by bucket and line."""
    upsert(path, updates.withColumnRenamed("bucket", "time"), _HOURLY, batch=batch)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, _HOURLY).drop(HOUR).withColumnRenamed("time", "bucket")


def refresh_hourly(
    spark: SparkSession, metrics_path: str, hourly_path: str, as_of: datetime, *, batch: str | int
) -> None:
    """One run of the scheduled rollup refresh over the stored metric table.

    Reads the last three hours of partitions only, recomputes the hours that are
    complete and upserts them.
    """
    recent = read_between(spark, metrics_path, schemas.OEE_METRICS, as_of - timedelta(hours=3), as_of)
    upsert_hourly(hourly_path, refreshed_hours(recent, as_of), batch=batch)


def refresh_changed(spark: SparkSession, metrics_path: str, hourly_path: str, as_of: datetime, *, batch: str | int) -> list[str]:
    """Recomputes every complete hour that has changed since its rollup, however old it is.

    The entries are taken back once the rollup is stored, so a refresh that
    is lost on the way is made again. Returns the hours.
    """
    complete = in_utc(as_of).strftime("%Y-%m-%d-%H")
    due = {hour: names for hour, names in changed_hours(spark, metrics_path).items() if hour < complete}
    present = sorted(set(due).intersection(folders.partition_values(spark, metrics_path, HOUR)))
    if present:
        rows = _read_hours(spark, metrics_path, schemas.OEE_METRICS, present)
        upsert_hourly(hourly_path, oee_hourly(rows), batch=batch)
    settle(spark, metrics_path, [name for names in due.values() for name in names])
    return present


def alert_rows(found: DataFrame) -> DataFrame:
    """Alerts in the table's layout, with its defaults filled in.

    The id is derived from machine and fault event, so that finding the same
    alert again gives the same row.
    """
    return found.select(
        F.xxhash64("equipment_id", F.col("event_id").cast("string")).alias("id"),
        "timestamp",
        "equipment_id",
        "line_id",
        "alert_type",
        "severity",
        F.col("temperature_c").try_cast("decimal(6,2)").alias("temperature_c"),
        "fault_code",
        F.lit(False).alias("acknowledged"),
        F.current_timestamp().alias("created_at"),
    )


def append_alerts(path: str, found: DataFrame, *, batch: int, run: str) -> None:
    """Adds a batch of alerts; a repeated batch replaces its own earlier rows only.

    ``run`` tells apart the batches of different runs, whose numbers all begin
    at 0. Alerts are kept for good, so the table is partitioned by day; a batch
    writes one file per day of ordinary size, and none without alerts.
    """
    (
        alert_rows(found)
        .withColumns(
            {"alert_date": F.to_date("timestamp"), "run": F.lit(run), "batch": F.lit(batch).cast("bigint")}
        )
        .hint("rebalance", "alert_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("alert_date", "run", "batch")
        .parquet(path)
    )


ACKNOWLEDGEMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("acknowledged", T.BooleanType()),
        T.StructField("said_at", T.TimestampType()),
        T.StructField("said_by", T.StringType()),
    ]
)


def acknowledge(path: str, said: DataFrame, *, entry: str) -> None:
    """Adds what operators said of alerts to the log beside the alert table.

    ``said`` has the alert's id and timestamp, and ``acknowledged`` (false opens
    it again), ``said_at`` and ``said_by``. Nothing in the log is ever changed;
    a repeated ``entry`` replaces its own rows only. The log is kept by the
    alerts' days, so that merging opens the same days as reading does.
    """
    (
        said.withColumns({"alert_date": F.to_date("timestamp"), "entry": F.lit(entry)})
        .select(*ACKNOWLEDGEMENTS.fieldNames(), "alert_date", "entry")
        .hint("rebalance", "alert_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("alert_date", "entry")
        .parquet(f"{path}__acknowledged")
    )


def _of_days(spark: SparkSession, path: str, layout: T.StructType, since: datetime | None) -> DataFrame:
    """A table by day; of its folders only those from a day on are opened."""
    first = "" if since is None else in_utc(since).strftime("%Y-%m-%d")
    days = [d for d in folders.partition_values(spark, path, "alert_date") if d >= first]
    if not days:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", path).parquet(*[f"{path}/alert_date={d}" for d in days])


def read_alerts(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The alert table, optionally from a moment on, as acknowledged by now; earlier days are not opened.

    Of several entries on an alert the last one holds; of the same moment, the
    one of the greater name, then the one that acknowledges.
    """
    by_day = [T.StructField("alert_date", T.DateType())]
    run = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
    alerts = _of_days(spark, path, T.StructType(schemas.ALERTS.fields + by_day + run), since)
    entry = [T.StructField("entry", T.StringType())]
    log = _of_days(spark, f"{path}__acknowledged", T.StructType(ACKNOWLEDGEMENTS.fields + by_day + entry), since)
    last = log.groupBy("alert_date", "id").agg(F.max(F.struct("said_at", "said_by", "acknowledged")).alias("said"))
    columns = alerts.columns
    merged = alerts.join(last, ["alert_date", "id"], "left").withColumn(
        "acknowledged", F.coalesce("said.acknowledged", "acknowledged")
    )
    if since is not None:
        merged = merged.filter(F.col("timestamp") >= instant(since))
    return merged.select(*columns)


def apply_retention(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    days: int = schemas.HOT_RETENTION_DAYS,
    *,
    column: str = HOUR,
    fmt: str = "%Y-%m-%d-%H",
) -> list[str]:
    """Drops the partitions that lie wholly before ``as_of - days``.

    Works on folder names; no data is read. The partition that contains the
    cutoff is kept. Returns the dropped partition values.
    """
    cutoff = (in_utc(as_of) - timedelta(days=days)).strftime(fmt)
    expired = [v for v in folders.partition_values(spark, path, column) if v < cutoff]
    for value in expired:
        folders.drop(spark, f"{path}/{column}={value}")
        folders.drop(spark, f"{path}__summary/{column}={value}")
    return expired
