from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import cycle, line_frame, status, status_frame

from millwright import cli, schemas
from millwright.sinks import archive, compaction, folders

DAY = 86400
TABLE = "line_events"
AFTER = datetime(2024, 3, 18)


def fill(spark, root, batches=4, days=3):
    """Every batch holds a row for each day and line."""
    for number in range(batches):
        rows = [
            cycle(day * DAY + number, event_id=f"{number}-{day}-{line}", line_id=line)
            for day in range(days)
            for line in ("LINE-A", "LINE-B")
        ]
        archive.append_snapshot(root, TABLE, line_frame(spark, rows), number, run="t")


def found(spark, root, **options):
    rows = archive.scan(spark, root, TABLE, **options)
    return sorted((r.event_id, r.ts, r.line_id, r.snapshot_id, str(r.event_date)) for r in rows.collect())


def test_compaction_changes_no_row(spark, tmp_path):
    root = str(tmp_path)
    fill(spark, root)
    views = [{}, {"as_of_snapshot": 1}, {"since": datetime(2024, 3, 16)}, {"until": datetime(2024, 3, 16, 12)}]
    before = [found(spark, root, **view) for view in views]
    files = len(archive.scan(spark, root, TABLE).inputFiles())
    assert compaction.compact_days(spark, root, TABLE, datetime(2024, 3, 17, 5)) == ["2024-03-15", "2024-03-16"]
    assert [found(spark, root, **view) for view in views] == before
    assert len(archive.scan(spark, root, TABLE).inputFiles()) < files
    assert folders.partition_values(spark, f"{root}/{TABLE}/data", "event_date") == ["2024-03-17"]
    assert compaction.compact_days(spark, root, TABLE, datetime(2024, 3, 17, 5)) == []


def test_late_rows_of_a_compacted_day(spark, tmp_path):
    root = str(tmp_path)
    fill(spark, root, batches=2)
    compaction.compact_days(spark, root, TABLE, AFTER)
    late = [cycle(DAY + 50, event_id="late", line_id="LINE-B")]
    archive.append_snapshot(root, TABLE, line_frame(spark, late), 2, run="t")
    before = found(spark, root)
    assert len(before) == 13 and len(found(spark, root, as_of_snapshot=1)) == 12
    assert compaction.compact_days(spark, root, TABLE, AFTER) == ["2024-03-16"]
    assert found(spark, root) == before
    copies = folders.partition_values(spark, f"{archive.packed_path(root, TABLE)}/event_date=2024-03-16", "through")
    assert copies == ["2"]


@pytest.mark.parametrize("step", ["rename", "drop"])
def test_a_lost_driver_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    fill(spark, root)
    before = found(spark, root)
    whole = getattr(folders, step)

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(folders, step, lost)
    with pytest.raises(RuntimeError):
        compaction.compact_days(spark, root, TABLE, AFTER)
    assert found(spark, root) == before
    monkeypatch.setattr(folders, step, whole)
    compaction.compact_days(spark, root, TABLE, AFTER)
    assert found(spark, root) == before
    assert folders.partition_values(spark, f"{root}/{TABLE}/data", "event_date") == []


def test_a_claimed_batch_holds_compaction_back(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    fill(spark, root, batches=1)
    commit = archive._commit

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(archive, "_commit", lost)
    with pytest.raises(RuntimeError):
        archive.append_snapshot(root, TABLE, line_frame(spark, [cycle(9, event_id="open")]), 1, run="t")
    monkeypatch.setattr(archive, "_commit", commit)
    archive.append_snapshot(root, TABLE, line_frame(spark, [cycle(10, event_id="other")]), 2, run="u")
    assert archive.settled(spark, root, TABLE) == 0
    compaction.compact_days(spark, root, TABLE, AFTER)
    assert len(found(spark, root)) == 7
    archive.append_snapshot(root, TABLE, line_frame(spark, [cycle(9, event_id="open")]), 1, run="t")
    compaction.compact_days(spark, root, TABLE, AFTER)
    rows = found(spark, root)
    assert len(rows) == 8 and {"open", "other"} <= {r[0] for r in rows}


def test_retention_takes_compacted_days_too(spark, tmp_path):
    root = str(tmp_path)
    fill(spark, root)
    compaction.compact_days(spark, root, TABLE, AFTER)
    assert archive.apply_archive_retention(spark, root, TABLE, datetime(2024, 3, 17), 1) == ["2024-03-15"]
    assert len(found(spark, root)) == 16
    listed = {r.table: r.rows for r in archive.list_tables(spark, root).collect()}
    assert listed[TABLE] == 16


def test_an_empty_archive_and_rows_without_a_time(spark, tmp_path):
    root = str(tmp_path)
    assert compaction.compact_days(spark, root, TABLE, AFTER) == []
    rows = line_frame(spark, [cycle(0), cycle(1, ts=None)])
    archive.append_snapshot(root, TABLE, rows, 0, run="t")
    before = archive.scan(spark, root, TABLE).count()
    assert compaction.compact_days(spark, root, TABLE, AFTER) == ["2024-03-15"]
    assert archive.scan(spark, root, TABLE).count() == before == 2


def rows_read(df):
    """Rows that left the scans of a plan, behind the row groups and pages that were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if node.nodeName().startswith("ColumnarToRow") or node.children().size():
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_point_lookup_reads_below_a_tenth(spark, tmp_path):
    root = str(tmp_path)
    machines, n = 40, 60_000
    many = (
        status_frame(spark, [status(0)])
        .drop("equipment_id", "ts", "event_id")
        .crossJoin(spark.range(n))
        .withColumns(
            {
                "equipment_id": F.format_string("M-%03d", F.col("id") % machines),
                "event_id": F.sha2(F.col("id").cast("string"), 256),
                "ts": F.timestamp_seconds(F.lit(1710489600) + F.col("id") % 3600),
            }
        )
        .drop("id")
    )
    archive.append_snapshot(root, "equipment_status", many, 0, run="t")
    one = {"where": F.col("equipment_id") == "M-017"}
    loose = rows_read(archive.scan(spark, root, "equipment_status", **one))
    compaction.compact_days(spark, root, "equipment_status", AFTER)
    lookup = archive.scan(spark, root, "equipment_status", **one)
    assert lookup.count() == n // machines
    read = rows_read(lookup)
    assert loose == n and n // machines <= read < n / 10


def test_the_command(spark, tmp_path):
    root = str(tmp_path)
    fill(spark, root)
    options = cli.parser().parse_args(["compact", "--archive", root, "--as-of", "2024-03-17T00:30:00"])
    assert cli.compact(spark, options) == [f"{TABLE} 2024-03-15"]
    assert set(schemas.EVENT_TABLES) >= {TABLE}
