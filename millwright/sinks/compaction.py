"""Compaction of the archive: many small snapshot folders of a day become one sorted copy.

A streaming job leaves a folder per day, line and micro-batch. Once a day is
over, its committed rows are written again: partitioned by line, sorted by
what lookups ask for, with Bloom filters on the ids. The snapshot id becomes an
ordinary column, so every snapshot stays readable. Late rows for a compacted
day land in snapshot folders as ever and are taken in by the next run.

A copy is named by the last snapshot in it and appears by one rename; from
then on readers leave the older folders alone, so these can go at any time
later. A run that dies before the rename has changed nothing; one that dies
after it leaves folders that the next run drops. A snapshot that is claimed
but not in the log holds compaction back to the ids before it. A reader that
listed its files before the old ones went has to read again.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.clock import in_utc
from millwright.sinks import archive, folders

#: columns that lookups name single values of, in sorting order
LOOKED_UP = ("equipment_id", "batch_id", "work_unit_id", "event_id")

#: rows of a page, the unit that a lookup can skip inside a file
PAGE_ROWS = 2048


def _loose(spark: SparkSession, root: str, table: str, day: str) -> list[tuple[int, str]]:
    """(snapshot id, folder) of a day's snapshot folders."""
    base = f"{root}/{table}/data/event_date={day}"
    return [
        (int(number), f"{base}/line_id={line}/snapshot_id={number}")
        for line in folders.partition_values(spark, base, "line_id")
        for number in folders.partition_values(spark, f"{base}/line_id={line}", "snapshot_id")
    ]


def _tidy(spark: SparkSession, root: str, table: str, day: str) -> None:
    """Drops what the newest copy of a day has replaced."""
    last = archive.packed_through(spark, root, table, day)
    if last is None:
        return
    copies = f"{archive.packed_path(root, table)}/event_date={day}"
    for number in folders.partition_values(spark, copies, "through"):
        if int(number) < last:
            folders.drop(spark, f"{copies}/through={number}")
    held = _loose(spark, root, table, day)
    if all(number <= last for number, _ in held):
        folders.drop(spark, f"{root}/{table}/data/event_date={day}")
        return
    for number, folder in held:
        if number <= last:
            folders.drop(spark, folder)


def compact_days(
    spark: SparkSession, root: str, table: str, before: datetime, extra: T.StructType | None = None
) -> list[str]:
    """Compacts the days that lie wholly before ``before``; returns those that had something to take in.

    All days are written by one job. ``rebalance`` gathers the rows of a day
    and line and lets adaptive execution split those too large for one task.
    """
    limit = in_utc(before).strftime("%Y-%m-%d")
    last = archive.settled(spark, root, table)
    due = []
    for day in folders.partition_values(spark, f"{root}/{table}/data", "event_date"):
        # the folder of rows without a time sorts behind all days
        if day >= limit:
            continue
        _tidy(spark, root, table, day)
        if any(number <= last for number, _ in _loose(spark, root, table, day)):
            due.append(day)
    if not due:
        return []
    ids = [number for number in archive.committed(spark, root, table) if number <= last]
    named = [name for name in LOOKED_UP if name in schemas.EVENT_TABLES[table].fieldNames()]
    rows = archive.read_data(spark, root, table, days=(due[0], due[-1]), extra=extra)
    rows = rows.filter(archive.in_ranges(F.col("snapshot_id"), ids)).filter(
        F.col("event_date").isin([datetime.fromisoformat(day).date() for day in due])
    )
    staged = f"{root}/{table}/unfinished/packed-{uuid.uuid4().hex}"
    writer = (
        rows.hint("rebalance", "event_date", "line_id")
        .sortWithinPartitions("event_date", "line_id", *named, "ts")
        .write.partitionBy("event_date", "line_id")
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    for name in named:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(staged)
    for day in due:
        target = f"{archive.packed_path(root, table)}/event_date={day}"
        made = f"{staged}/event_date={day}"
        folders.make(spark, target)
        # a day whose folders hold no committed row has nothing to show
        if not folders.exists(spark, made):
            folders.make(spark, made)
        folders.rename(spark, made, f"{target}/through={last}")
        _tidy(spark, root, table, day)
    folders.drop(spark, staged)
    return due
