"""The append-only event archive with snapshots.

Each micro-batch is one snapshot, and a table has one writer at a time. A
batch first claims the next free snapshot id, then writes its data files,
partitioned by day, line and snapshot, and at last renames its log entry into
place. Readers only see the ids in the log, so a half-written batch is
invisible. Claim and entry carry the run and the number of the batch: a
repeated batch finds its entry and adds nothing, or finds its claim and
replaces its own files, and an id that was claimed is never given to another.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.clock import in_utc, instant
from millwright.sinks import folders, tables
from millwright.sources.feeds import normalize

PARTITIONS = ("event_date", "line_id", "snapshot_id")

_LOG = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("added_records", T.LongType()),
    ]
)


def _data(root: str, table: str) -> str:
    return f"{root}/{table}/data"


def _log(root: str, table: str) -> str:
    return f"{root}/{table}/snapshots"


def stored_layout(table: str, extra: T.StructType | None = None) -> T.StructType:
    """Columns as stored: the contract, the times, and the partition columns last.

    ``extra`` names columns added to the contract later; files written before
    that simply read as null there.
    """
    own = [f for f in schemas.EVENT_TABLES[table].fields if f.name != "line_id"]
    times = [T.StructField("ts", T.TimestampType()), T.StructField("ingested_at", T.TimestampType())]
    added = [] if extra is None else list(extra.fields)
    last = [
        T.StructField("event_date", T.DateType()),
        T.StructField("line_id", T.StringType()),
        T.StructField("snapshot_id", T.LongType()),
    ]
    return T.StructType(own + times + added + last)


def _entries(spark: SparkSession, root: str, table: str) -> dict[tuple[str, str], int]:
    """Committed snapshots: (run, batch) -> id, from names alone."""
    return _named(folders.partition_values(spark, _log(root, table), "snapshot"))


def _claims(root: str, table: str) -> str:
    return f"{root}/{table}/claims"


def _named(names: list[str]) -> dict[tuple[str, str], int]:
    split = [name.split(".", 2) for name in names]
    return {(run, batch): int(number) for number, batch, run in split}


def _name(number: int, batch: int | str, run: str) -> str:
    return f"{number:09d}.{batch}.{run}"


def _claim(spark: SparkSession, root: str, table: str, batch: int, run: str) -> int | None:
    """The snapshot id for a batch, or none if the batch is in the log."""
    done, claimed = _entries(spark, root, table), _named(folders.names(spark, _claims(root, table)))
    key = (run, str(batch))
    if key in done:
        return None
    if key not in claimed:
        claimed[key] = max(batch, 1 + max([*done.values(), *claimed.values()], default=-1))
        folders.touch(spark, f"{_claims(root, table)}/{_name(claimed[key], batch, run)}")
    return claimed[key]


def _commit(
    spark: SparkSession, root: str, table: str, number: int, batch: int | str, run: str,
    operation: str, added: int, committed_at: Column | None = None,
) -> None:
    entry = spark.range(1).select(
        F.lit(number).cast("bigint").alias("snapshot_id"),
        (F.current_timestamp() if committed_at is None else committed_at).alias("committed_at"),
        F.lit(operation).alias("operation"),
        F.lit(added).cast("bigint").alias("added_records"),
    )
    name = _name(number, batch, run)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{root}/{table}/unfinished/{name}")
    folders.make(spark, _log(root, table))
    folders.rename(spark, f"{root}/{table}/unfinished/{name}", f"{_log(root, table)}/snapshot={name}")
    folders.drop(spark, f"{_claims(root, table)}/{name}")


def append_snapshot(
    root: str,
    table: str,
    events: DataFrame,
    batch: int,
    *,
    run: str,
    committed_at: Column | None = None,
    extra: T.StructType | None = None,
) -> None:
    """Appends one batch as one snapshot; a batch without rows leaves no trace.

    ``run`` tells apart the batches of different runs, whose numbers all begin
    at 0. The id of the snapshot is the batch number if that is still free, or
    else the next one. Rows are gathered by day and line before writing, which
    bounds the number of files; ``rebalance`` lets adaptive execution split a
    line that is too large for one task and merge those that are small.
    """
    spark = events.sparkSession
    snapshot_id = _claim(spark, root, table, batch, run)
    if snapshot_id is None:
        return
    kept = () if extra is None else extra.fieldNames()
    rows = normalize(events, table, keep=tuple(kept))
    layout = stored_layout(table, extra)
    shaped = rows.withColumns(
        {
            "event_date": F.to_date("ts"),
            # an empty partition value could not be told from a missing one
            "line_id": F.when(F.col("line_id") != "", F.col("line_id")).otherwise(schemas.UNKNOWN),
            "snapshot_id": F.lit(snapshot_id).cast("bigint"),
        }
    ).select(*layout.fieldNames())
    written = Observation()
    (
        # counted behind the shuffle, in the task that writes, hence once per row
        shaped.hint("rebalance", "event_date", "line_id")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(_data(root, table))
    )
    added = written.get.get("rows", 0)
    if added == 0:
        folders.drop(spark, f"{_claims(root, table)}/{_name(snapshot_id, batch, run)}")
        return
    _commit(spark, root, table, snapshot_id, batch, run, "append", added, committed_at)


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """Creates the missing ones of the three archive tables; returns their names."""
    created = []
    for table in schemas.EVENT_TABLES:
        if tables.create_if_missing(spark, _log(root, table), _LOG):
            created.append(table)
    return created


def packed_path(root: str, table: str) -> str:
    return f"{root}/{table}/packed"


def packed_through(spark: SparkSession, root: str, table: str, day: str) -> int | None:
    """The last snapshot whose rows of a day are in the day's compacted copy, if there is one."""
    copies = folders.partition_values(spark, f"{packed_path(root, table)}/event_date={day}", "through")
    return max(map(int, copies), default=None)


def read_data(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    days: tuple[str | None, str | None] = (None, None),
    extra: T.StructType | None = None,
) -> DataFrame:
    """All files of a table, committed or not; with ``days`` only the folders of those are opened.

    A compacted day is read from its newest copy, and its snapshot folders
    count only from the first snapshot that is not in the copy.
    """
    layout, path, packed = stored_layout(table, extra), _data(root, table), packed_path(root, table)
    low, high = days

    def among(folder: str) -> list[str]:
        named = folders.partition_values(spark, folder, "event_date")
        return [day for day in named if (low is None or day >= low) and (high is None or day <= high)]

    loose = among(path)
    copies = {day: packed_through(spark, root, table, day) for day in among(packed)}
    copies = {day: last for day, last in copies.items() if last is not None}
    whole = low is None and high is None
    found = ([path] if loose else []) if whole else [f"{path}/event_date={day}" for day in loose]
    rows = spark.createDataFrame([], layout)
    if found:
        rows = spark.read.schema(layout).option("basePath", path).parquet(*found)
        for day in set(loose) & set(copies):
            rows = rows.filter(
                F.coalesce(F.col("event_date") != F.lit(day).cast("date"), F.lit(True))
                | (F.col("snapshot_id") > copies[day])
            )
    if copies:
        old = spark.read.schema(layout).option("basePath", packed).parquet(
            *[f"{packed}/event_date={day}/through={last}" for day, last in copies.items()]
        )
        old = old.select(*layout.fieldNames())
        rows = rows.unionByName(old) if found else old
    return rows


def snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Snapshot history, oldest first."""
    path = _log(root, table)
    if not folders.has_data(spark, path):
        return spark.createDataFrame([], _LOG)
    return spark.read.schema(_LOG).option("recursiveFileLookup", "true").parquet(path)


def committed(spark: SparkSession, root: str, table: str, as_of: datetime | None = None) -> list[int]:
    """Ids in the log in order, or those committed by ``as_of``.

    The current ones are found from folder names, without reading the log.
    """
    if as_of is None:
        return sorted(_entries(spark, root, table).values())
    log = snapshots(spark, root, table).filter(F.col("committed_at") <= instant(as_of))
    return sorted(row[0] for row in log.select("snapshot_id").toLocalIterator())


def settled(spark: SparkSession, root: str, table: str) -> int:
    """The last committed snapshot before the first one that is claimed and not in the log; -1 if there is none."""
    done = _entries(spark, root, table)
    claims = _named(folders.names(spark, _claims(root, table)))
    still_open = [number for key, number in claims.items() if key not in done]
    return max((n for n in done.values() if n < min(still_open, default=n + 1)), default=-1)


def in_ranges(column: Column, ids: list[int]) -> Column:
    """Membership as a few ranges: literals, so that partitions are pruned by them."""
    ranges: list[list[int]] = []
    for number in ids:
        if ranges and number == ranges[-1][1] + 1:
            ranges[-1][1] = number
        else:
            ranges.append([number, number])
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | column.between(low, high)
    return inside


def scan(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    as_of_snapshot: int | None = None,
    as_of_time: datetime | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
    where: Column | str | None = None,
    limit: int | None = None,
    extra: T.StructType | None = None,
) -> DataFrame:
    """The table as it was after a snapshot, or at a time; by default as it is now.

    An id that is not in the log is an error. The ids to read are literals on a
    partition column, so other files are pruned before anything is read.
    ``since`` and ``until`` bound the event time; only days between are opened.
    """
    ids = committed(spark, root, table, as_of_time)
    if as_of_snapshot is not None:
        if as_of_snapshot not in ids:
            raise ValueError(f"{table} has no snapshot {as_of_snapshot}")
        ids = [number for number in ids if number <= as_of_snapshot]
    days = tuple(None if t is None else in_utc(t).strftime("%Y-%m-%d") for t in (since, until))
    rows = read_data(spark, root, table, days=days, extra=extra).filter(in_ranges(F.col("snapshot_id"), ids))
    for moment, inside in ((since, lambda c, m: c >= m), (until, lambda c, m: c <= m)):
        if moment is not None:
            rows = rows.filter(
                inside(F.col("ts"), instant(moment))
                & inside(F.col("event_date"), F.lit(in_utc(moment).date()))
            )
    if where is not None:
        rows = rows.filter(where)
    return rows if limit is None else rows.limit(limit)


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Archive tables with their number of snapshots and rows, from the logs alone."""
    listed = None
    for table in schemas.EVENT_TABLES:
        one = snapshots(spark, root, table).agg(
            F.count(F.lit(1)).alias("snapshots"),
            F.coalesce(F.sum("added_records"), F.lit(0)).alias("rows"),
        ).select(F.lit(table).alias("table"), "snapshots", "rows")
        listed = one if listed is None else listed.unionByName(one)
    return listed


def _retentions(root: str, table: str) -> str:
    return f"{root}/{table}/retentions"


def _days(spark: SparkSession, root: str, table: str) -> list[str]:
    """Days with rows, compacted or not."""
    paths = (_data(root, table), packed_path(root, table))
    return sorted({day for path in paths for day in folders.partition_values(spark, path, "event_date")})


def _finish_retentions(spark: SparkSession, root: str, table: str) -> list[str]:
    """Drops what an interrupted retention has already taken off the log; one that logged nothing is forgotten."""
    dropped = []
    done = {batch for run, batch in _entries(spark, root, table) if run == "retention"}
    for name in folders.names(spark, _retentions(root, table)):
        cutoff = name.split("~")[0]
        if name in done:
            for day in _days(spark, root, table):
                if day < cutoff:
                    for path in (_data(root, table), packed_path(root, table)):
                        folders.drop(spark, f"{path}/event_date={day}")
                    dropped.append(day)
        folders.drop(spark, f"{_retentions(root, table)}/{name}")
    return dropped


def apply_archive_retention(
    spark: SparkSession, root: str, table: str, as_of: datetime, days: int = schemas.ARCHIVE_RETENTION_DAYS
) -> list[str]:
    """Drops the days that lie wholly before ``as_of - days``; the log gets an entry with the rows removed.

    The entry is logged before the first folder goes, under the name of a
    marker that is taken back after the last one. A driver that dies in
    between leaves the marker, and the next retention drops the rest without
    counting it again. The rows are counted from what readers can see.
    """
    dropped = _finish_retentions(spark, root, table)
    cutoff = (in_utc(as_of) - timedelta(days=days)).strftime("%Y-%m-%d")
    if not any(day < cutoff for day in _days(spark, root, table)):
        return dropped
    name = f"{cutoff}~{uuid.uuid4().hex}"
    folders.touch(spark, f"{_retentions(root, table)}/{name}")
    gone = scan(spark, root, table, where=F.col("event_date") < F.lit(cutoff).cast("date")).count()
    taken = [*_entries(spark, root, table).values(), *_named(folders.names(spark, _claims(root, table))).values()]
    _commit(spark, root, table, 1 + max(taken, default=-1), name, "retention", "delete", -gone)
    return dropped + _finish_retentions(spark, root, table)
