from __future__ import annotations

from datetime import datetime

import pytest
from support import at, batch, batch_frame, cycle, fault, line_frame, status, status_frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.operators.precursors import fault_precursors
from millwright.sinks import archive, folders, tables


def metric_rows(spark, *rows):
    layout = (
        "time timestamp, line_id string, availability double, performance double, quality double, "
        "oee double, total_units bigint, good_units bigint"
    )
    return spark.createDataFrame(
        [(at(s), line, 1.0, 1.0, 1.0, oee, 10, 10) for s, line, oee in rows], layout
    )


def stored(spark, path):
    found = tables.read_table(spark, path, schemas.OEE_METRICS).orderBy("time", "line_id").collect()
    return [(r.line_id, float(r.oee)) for r in found]


def test_upsert_inserts_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-A", 0.1), (0, "LINE-B", 0.2)), batch=1)
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-B", 0.9), (7200, "LINE-A", 0.3)), batch=2)
    want = [("LINE-A", 0.1), ("LINE-B", 0.9), ("LINE-A", 0.3)]
    assert stored(spark, path) == want
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-B", 0.9), (7200, "LINE-A", 0.3)), batch=2)
    assert stored(spark, path) == want
    assert folders.partition_values(spark, path, "hour") == ["2024-03-15-08", "2024-03-15-10"]


def test_upsert_with_copies_of_a_key_in_one_batch(spark, tmp_path):
    path = str(tmp_path / "metrics")
    updates = metric_rows(spark, *[(0, "LINE-A", i / 1000) for i in range(500)])
    versioned = updates.withColumn("seen", -F.col("oee"))
    tables.upsert(path, versioned, schemas.OEE_METRICS, batch=1, version="seen")
    assert stored(spark, path) == [("LINE-A", 0.0)]


def test_untouched_hours_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-A", 0.1), (3600, "LINE-A", 0.2)), batch=1)
    before = sorted(p.name for p in (tmp_path / "metrics" / "hour=2024-03-15-08").glob("*.parquet"))
    tables.upsert_oee_metrics(path, metric_rows(spark, (3600, "LINE-A", 0.5)), batch=2)
    after = sorted(p.name for p in (tmp_path / "metrics" / "hour=2024-03-15-08").glob("*.parquet"))
    assert before == after


def test_interrupted_publish_is_finished_from_the_staged_copy(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-A", 0.1), (60, "LINE-A", 0.2)), batch=1)
    publish = tables.publish

    def lose_the_partition(session, staged, target, layout):
        folders.drop(session, f"{target}/hour=2024-03-15-08")
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "publish", lose_the_partition)
    update = metric_rows(spark, (60, "LINE-A", 0.7))
    with pytest.raises(RuntimeError):
        tables.upsert_oee_metrics(path, update, batch=2)
    assert stored(spark, path) == []
    monkeypatch.setattr(tables, "publish", publish)
    tables.upsert_oee_metrics(path, update, batch=2)
    assert stored(spark, path) == [("LINE-A", 0.1), ("LINE-A", 0.7)]


def test_a_left_over_copy_never_replaces_other_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-A", 0.1)), batch=0)
    publish = tables.publish

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "publish", lost)
    with pytest.raises(RuntimeError):
        tables.upsert_oee_metrics(path, metric_rows(spark, (60, "LINE-B", 0.2)), batch=0)
    monkeypatch.setattr(tables, "publish", publish)
    # a new run with the same batch number, then the late repetition of the first
    tables.upsert_oee_metrics(path, metric_rows(spark, (120, "LINE-C", 0.3)), batch=0)
    tables.upsert_oee_metrics(path, metric_rows(spark, (60, "LINE-B", 0.2)), batch=0)
    assert stored(spark, path) == [("LINE-A", 0.1), ("LINE-B", 0.2), ("LINE-C", 0.3)]
    assert folders.names(spark, f"{path}__staged") == []


def test_an_empty_update_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(path, metric_rows(spark, (0, "LINE-A", 0.1)).filter("false"), batch=0)
    assert stored(spark, path) == [] and folders.names(spark, f"{path}__staged") == []


def test_alerts_of_a_new_run_are_added(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for run, unit in (("a", "1"), ("b", "2"), ("b", "2")):
        machine = {"equipment_id": f"LINE-A-WU-0{unit}"}
        rows = [status(0, temperature_c=90.0, **machine), fault(5, **machine)]
        tables.append_alerts(path, fault_precursors(status_frame(spark, rows)), batch=0, run=run)
    assert sorted(r.equipment_id[-1] for r in tables.read_alerts(spark, path).collect()) == ["1", "2"]


def test_a_batch_of_alerts_writes_one_file_a_day(spark, tmp_path):
    rows = [r for i in range(40) for r in (status(i * 60, temperature_c=90.0), fault(i * 60 + 5))]
    found = fault_precursors(status_frame(spark, rows)).repartition(8)
    tables.append_alerts(str(tmp_path / "alerts"), found, batch=0, run="t")
    assert len(list((tmp_path / "alerts").glob("alert_date=*/run=t/batch=0/*.parquet"))) == 1


def test_figures_that_do_not_fit_become_null(spark, tmp_path):
    path = str(tmp_path / "stats")
    rows = spark.createDataFrame(
        [(at(0), "LINE-A", 12345.0, 10.0, 0.1, 5), (at(0), "LINE-B", 1.5, 10.0, 0.1, 5)],
        "time timestamp, line_id string, rolling_cpk double, rolling_mean double, "
        "rolling_stddev double, window_batches int",
    )
    tables.upsert_quality_stats(path, rows, batch=0)
    found = tables.read_table(spark, path, schemas.QUALITY_STATS).orderBy("line_id").collect()
    assert [r.rolling_cpk and float(r.rolling_cpk) for r in found] == [None, 1.5]


def test_alert_batches_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "alerts")
    found = fault_precursors(status_frame(spark, [status(0, temperature_c=90.0), fault(5)]))
    for _ in range(2):
        tables.append_alerts(path, found, batch=3, run="t")
    tables.append_alerts(path, found.filter("false"), batch=4, run="t")
    (row,) = tables.read_alerts(spark, path).collect()
    assert tables.read_alerts(spark, path, since=datetime(2024, 3, 16)).count() == 0
    assert tables.read_alerts(spark, path, since=datetime(2024, 3, 15)).count() == 1
    assert row.acknowledged is False and row.created_at is not None
    assert float(row.temperature_c) == 90.0


def test_retention_keeps_the_partition_of_the_cutoff(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(
        path, metric_rows(spark, *[(h * 3600, "LINE-A", 0.1) for h in range(4)]), batch=1
    )
    dropped = tables.apply_retention(spark, path, datetime(2024, 3, 22, 10, 30))
    assert dropped == ["2024-03-15-08", "2024-03-15-09"]
    assert folders.partition_values(spark, path, "hour") == ["2024-03-15-10", "2024-03-15-11"]


def test_time_range_prunes_hours(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.upsert_oee_metrics(
        path, metric_rows(spark, *[(h * 3600, "LINE-A", h / 10) for h in range(5)]), batch=1
    )
    table = tables.read_table(spark, path, schemas.OEE_METRICS)
    some = tables.in_hours(table, datetime(2024, 3, 15, 9), datetime(2024, 3, 15, 10))
    assert sorted(float(r.oee) for r in some.collect()) == [0.1, 0.2]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    opened = tables.read_between(spark, path, schemas.OEE_METRICS, datetime(2024, 3, 15, 9), datetime(2024, 3, 15, 10))
    assert sorted(float(r.oee) for r in opened.collect()) == [0.1, 0.2] and len(opened.inputFiles()) == 2


def test_scheduled_refresh_of_the_hourly_table(spark, tmp_path):
    metrics, hourly = str(tmp_path / "metrics"), str(tmp_path / "hourly")
    rows = [(h * 3600 + 60 * m, "LINE-A", h / 10) for h in range(5) for m in (1, 2)]
    tables.upsert_oee_metrics(metrics, metric_rows(spark, *rows), batch=1)
    for run, minute in enumerate((30, 59)):
        as_of = datetime(2024, 3, 15, 12, minute)
        tables.refresh_hourly(spark, metrics, hourly, as_of, batch=run)
    found = tables.read_hourly(spark, hourly).orderBy("bucket").collect()
    assert [(r.bucket.hour, r.avg_oee) for r in found] == [(10, 0.2), (11, 0.3)]


def test_missing_tables_are_created_once(spark, tmp_path):
    root = str(tmp_path / "archive")
    assert archive.ensure_tables(spark, root) == ["line_events", "equipment_status", "quality_metrics"]
    assert archive.ensure_tables(spark, root) == []
    assert {(r.table, r.snapshots, r.rows) for r in archive.list_tables(spark, root).collect()} == {
        (name, 0, 0) for name in schemas.EVENT_TABLES
    }
    assert archive.scan(spark, root, "line_events").count() == 0


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("history"))
    for number in (1, 2, 3):
        rows = [
            cycle((number * 86400) + i, event_id=f"{number}-{i}", line_id=line, units_produced=number)
            for i in range(4)
            for line in ("LINE-A", "LINE-B")
        ]
        stamp = F.lit(f"2024-04-0{number} 00:00:00").cast("timestamp")
        archive.append_snapshot(root, "line_events", line_frame(spark, rows), number, committed_at=stamp, run="t")
    return root


def test_snapshots_and_reads_as_of(spark, history):
    log = archive.snapshots(spark, history, "line_events").orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.operation, r.added_records) for r in log] == [
        (1, "append", 8),
        (2, "append", 8),
        (3, "append", 8),
    ]
    assert archive.scan(spark, history, "line_events").count() == 24
    assert archive.scan(spark, history, "line_events", as_of_snapshot=2).count() == 16
    assert archive.scan(spark, history, "line_events", as_of_time=datetime(2024, 4, 1, 1)).count() == 8
    assert archive.scan(spark, history, "line_events", as_of_time=datetime(2024, 3, 1)).count() == 0
    assert archive.scan(spark, history, "line_events", limit=5).count() == 5


def test_day_and_line_prune_partitions(spark, history):
    rows = archive.scan(
        spark,
        history,
        "line_events",
        where="event_date = DATE'2024-03-17' AND line_id = 'LINE-A' AND units_produced > 1",
    )
    assert rows.count() == 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in partition and "line_id" in partition and "snapshot_id" in partition
    assert "GreaterThan(units_produced,1)" in plan


def test_time_bounds_prune_days(spark, history):
    start, end = datetime(2024, 3, 17, 8, 0, 2), datetime(2024, 3, 17, 23)
    rows = archive.scan(spark, history, "line_events", since=start, until=end)
    assert rows.count() == 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.split("PartitionFilters: [")[1].split("]")[0].count("event_date") >= 2


def test_repeated_snapshot_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    rows = batch_frame(spark, [batch(i, event_id=str(i)) for i in range(6)])
    for _ in range(2):
        archive.append_snapshot(root, "quality_metrics", rows, 0, run="t")
    assert archive.scan(spark, root, "quality_metrics").count() == 6
    assert archive.snapshots(spark, root, "quality_metrics").count() == 1


def test_empty_batch_makes_no_snapshot(spark, tmp_path):
    root = str(tmp_path)
    archive.append_snapshot(root, "line_events", line_frame(spark, []), 0, run="t")
    archive.append_snapshot(root, "line_events", line_frame(spark, [cycle()]).filter("line_id = 'X'"), 1, run="t")
    assert archive.snapshots(spark, root, "line_events").count() == 0
    assert archive.scan(spark, root, "line_events").count() == 0


def test_only_snapshots_in_the_log_are_visible(spark, tmp_path):
    root = str(tmp_path)
    for number in range(3):
        archive.append_snapshot(root, "line_events", line_frame(spark, [cycle(number)]), number, run="t")
    entry = folders.partition_values(spark, f"{root}/line_events/snapshots", "snapshot")[1]
    folders.drop(spark, f"{root}/line_events/snapshots/snapshot={entry}")
    assert archive.read_data(spark, root, "line_events").count() == 3
    assert archive.committed(spark, root, "line_events") == [0, 2]
    assert sorted(r.snapshot_id for r in archive.scan(spark, root, "line_events").collect()) == [0, 2]
    assert archive.scan(spark, root, "line_events", as_of_snapshot=0).count() == 1
    for unknown in (1, 9):
        with pytest.raises(ValueError):
            archive.scan(spark, root, "line_events", as_of_snapshot=unknown)


def test_a_new_run_adds_to_the_archive(spark, tmp_path):
    root = str(tmp_path)
    for run, second in (("a", 0), ("b", 1), ("a", 0), ("b", 1)):
        archive.append_snapshot(root, "line_events", line_frame(spark, [cycle(second)]), 0, run=run)
    assert sorted(r.snapshot_id for r in archive.scan(spark, root, "line_events").collect()) == [0, 1]


def test_a_repeated_batch_finds_its_claim(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commit = archive._commit

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(archive, "_commit", lost)
    with pytest.raises(RuntimeError):
        archive.append_snapshot(root, "line_events", line_frame(spark, [cycle(0)]), 0, run="a")
    monkeypatch.setattr(archive, "_commit", commit)
    archive.append_snapshot(root, "line_events", line_frame(spark, [cycle(1), cycle(2)]), 0, run="b")
    assert [r.snapshot_id for r in archive.scan(spark, root, "line_events").collect()] == [1, 1]
    archive.append_snapshot(root, "line_events", line_frame(spark, [cycle(0)]), 0, run="a")
    assert sorted(r.snapshot_id for r in archive.scan(spark, root, "line_events").collect()) == [0, 1, 1]


def test_a_day_scan_opens_that_day_only(spark, history):
    start, end = datetime(2024, 3, 17), datetime(2024, 3, 17, 23)
    rows = archive.scan(spark, history, "line_events", since=start, until=end)
    assert rows.count() == 8 and all("event_date=2024-03-17" in f for f in rows.inputFiles())
    assert len(archive.scan(spark, history, "line_events").inputFiles()) > len(rows.inputFiles())


def test_added_column_reads_null_in_old_files(spark, tmp_path):
    root = str(tmp_path)
    extra = T.StructType([T.StructField("operator_id", T.StringType())])
    archive.append_snapshot(root, "line_events", line_frame(spark, [cycle()]), 0, run="t")
    named = line_frame(spark, [cycle(1)]).withColumn("operator_id", F.lit("OP-1"))
    archive.append_snapshot(root, "line_events", named, 1, extra=extra, run="t")
    found = archive.scan(spark, root, "line_events", extra=extra).orderBy("snapshot_id").collect()
    assert [r.operator_id for r in found] == [None, "OP-1"]


def test_archive_retention_drops_whole_days(spark, tmp_path):
    root = str(tmp_path)
    rows = line_frame(spark, [cycle(d * 86400, event_id=str(d)) for d in range(3)])
    archive.append_snapshot(root, "line_events", rows, 0, run="t")
    dropped = archive.apply_archive_retention(spark, root, "line_events", datetime(2024, 6, 14, 12))
    assert dropped == ["2024-03-15"]
    assert archive.scan(spark, root, "line_events").count() == 2
    listed = {r.table: (r.snapshots, r.rows) for r in archive.list_tables(spark, root).collect()}
    assert listed["line_events"] == (2, 2)
    assert archive.apply_archive_retention(spark, root, "line_events", datetime(2024, 6, 14, 12)) == []
    archive.append_snapshot(root, "line_events", rows.limit(1), 0, run="u")
    assert archive.committed(spark, root, "line_events") == [0, 1, 2]


def test_rows_without_a_line_or_time_are_kept(spark, tmp_path):
    root = str(tmp_path)
    rows = [cycle(line_id=None), cycle(line_id=""), cycle(ts=None)]
    archive.append_snapshot(root, "line_events", line_frame(spark, rows), 0, run="t")
    found = archive.scan(spark, root, "line_events").collect()
    assert sorted(r.line_id for r in found) == ["LINE-A", "UNKNOWN", "UNKNOWN"]


@pytest.mark.parametrize("step", ["scan", "_commit", "drop"])
def test_an_interrupted_archive_retention_counts_its_rows_once(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    day = 86_400
    rows = [batch(n * day, event_id=f"{n}-{k}") for n in range(6) for k in range(2)]
    archive.append_snapshot(root, "quality_metrics", batch_frame(spark, rows), 0, run="r")

    def lost(*_, **__):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(folders if step == "drop" else archive, step, lost)
        with pytest.raises(RuntimeError):
            archive.apply_archive_retention(spark, root, "quality_metrics", at(3 * day), 1)
    archive.apply_archive_retention(spark, root, "quality_metrics", at(4 * day), 1)
    listed = {r.table: r.rows for r in archive.list_tables(spark, root).collect()}
    assert listed["quality_metrics"] == archive.scan(spark, root, "quality_metrics").count() == 6
    assert folders.names(spark, f"{root}/quality_metrics/retentions") == []
    assert archive.apply_archive_retention(spark, root, "quality_metrics", at(4 * day), 1) == []
