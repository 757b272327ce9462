"""Acknowledged alerts, hour summaries, the change log and repeated deliveries."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from support import BASE, LINE_LAYOUT, at, cycle, line_frame

from millwright import schemas
from millwright.operators import rollups
from millwright.operators.oee import oee_by_window
from millwright.plans import serving
from millwright.sinks import folders, tables
from millwright.sources import feeds
from millwright.streaming import jobs


def metrics(spark, rows):
    """rows of (seconds, line, oee)"""
    full = [(at(s), line, oee, 0.5, 0.5, oee, 10, 9) for s, line, oee in rows]
    names = "time timestamp, line_id string, availability double, performance double, quality double, oee double, total_units int, good_units int"
    return spark.createDataFrame(full, names)


def opened(df):
    """Hour partitions that a plan reads."""
    return sorted({f.split("hour=")[1].split("/")[0] for f in df.inputFiles()})


def alerts(spark, seconds):
    rows = [(f"e{s}", at(s), "M1", "LINE-A", "THERMAL_FAULT_PRECURSOR", "HIGH", 90.0, "E-042") for s in seconds]
    return spark.createDataFrame(
        rows,
        "event_id string, timestamp timestamp, equipment_id string, line_id string, alert_type string, severity string, "
        "temperature_c double, fault_code string",
    )


def test_the_last_word_on_an_alert_holds(spark, tmp_path):
    path = f"{tmp_path}/alerts"
    day = 86_400
    tables.append_alerts(path, alerts(spark, [0, 60, 120, day]), batch=0, run="r")
    assert tables.read_alerts(spark, path).filter("acknowledged").count() == 0
    raised = {r.timestamp: r for r in tables.read_alerts(spark, path).collect()}

    def say(entry, *said):
        rows = [(raised[k].id, k, flag, at(s), by) for k, flag, s, by in said]
        log = spark.createDataFrame(rows, "id long, timestamp timestamp, acknowledged boolean, said_at timestamp, said_by string")
        tables.acknowledge(path, log, entry=entry)

    one, two, three, four = sorted(raised)
    say("b", (one, False, 500, "x"), (two, True, 500, "x"), (four, True, 500, "x"))
    for _ in range(2):  # a repeated entry adds nothing
        say("a", (one, True, 400, "y"), (two, False, 500, "w"))
    got = {r.timestamp: r.acknowledged for r in tables.read_alerts(spark, path).collect()}
    assert got == {one: False, two: True, three: False, four: True}
    since = tables.read_alerts(spark, path, BASE + timedelta(seconds=day))
    assert [r.timestamp for r in since.collect()] == [four]
    assert all("alert_date=2024-03-16" in f for f in since.inputFiles())
    assert serving.open_alert_count(tables.read_alerts(spark, path)).first().alerts == 2


def test_newest_rows_open_their_hours_only(spark, tmp_path):
    path = f"{tmp_path}/oee"
    rows = [(h * 3600 + 60, line, 0.5 + h / 100) for h in range(12) for line in ("LINE-A", "LINE-B") if line == "LINE-A" or h < 5]
    tables.upsert_oee_metrics(path, metrics(spark, rows), batch=0)
    near = tables.newest_of_lines(spark, path, schemas.OEE_METRICS)
    assert opened(near) == ["2024-03-15-12", "2024-03-15-19"]
    whole = tables.read_table(spark, path, schemas.OEE_METRICS)
    assert sorted(rollups.latest_by_line(near, ["oee"]).collect()) == sorted(rollups.latest_by_line(whole, ["oee"]).collect())
    assert opened(tables.newest_hour(spark, path, schemas.OEE_METRICS)) == ["2024-03-15-19"]
    tables.apply_retention(spark, path, BASE + timedelta(hours=9), days=0)
    assert opened(tables.newest_of_lines(spark, path, schemas.OEE_METRICS)) == ["2024-03-15-19"]
    assert tables.newest_of_lines(spark, f"{tmp_path}/none", schemas.OEE_METRICS).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_smallest_rows_stop_where_no_hour_can_matter(spark, tmp_path, seed):
    rng = random.Random(seed)
    path = f"{tmp_path}/oee"
    level = [rng.random() for _ in range(16)]
    rows = [
        (h * 3600 + m * 60, "LINE-A", None if rng.random() < 0.01 * seed else min(1.0, round(level[h] + m / 1000, 4)))
        for h in range(16)
        for m in range(0, 60, 5)
    ]
    tables.upsert_oee_metrics(path, metrics(spark, rows), batch=0)
    near = tables.smallest(spark, path, schemas.OEE_METRICS, "oee", 5)
    whole = tables.read_table(spark, path, schemas.OEE_METRICS)
    assert serving.worst_windows(near, limit=5).collect() == serving.worst_windows(whole, limit=5).collect()
    if seed == 0:
        assert len(opened(near)) < 16
    start, end = at(3 * 3600), at(9 * 3600)
    near = tables.smallest(spark, path, schemas.OEE_METRICS, "oee", 5, start, end)
    assert (
        serving.worst_windows(near, start=start, end=end, limit=5).collect()
        == serving.worst_windows(whole, start=start, end=end, limit=5).collect()
    )


def test_a_rollup_follows_late_rows_of_any_age(spark, tmp_path):
    path, hourly = f"{tmp_path}/oee", f"{tmp_path}/hourly"
    rows = [(h * 3600 + 60, "LINE-A", 0.5) for h in range(10)]
    tables.upsert_oee_metrics(path, metrics(spark, rows), batch=0)
    as_of = BASE + timedelta(hours=9, minutes=30)
    assert len(tables.refresh_changed(spark, path, hourly, as_of, batch=0)) == 9  # the running hour stays due
    assert tables.refresh_changed(spark, path, hourly, as_of, batch=1) == []
    tables.upsert_oee_metrics(path, metrics(spark, [(120, "LINE-A", 0.9), (180, "LINE-B", 0.1)]), batch=1)
    assert tables.refresh_changed(spark, path, hourly, as_of, batch=2) == ["2024-03-15-08"]
    assert tables.refresh_changed(spark, path, hourly, as_of + timedelta(hours=1), batch=3) == ["2024-03-15-17"]
    want = rollups.oee_hourly(tables.read_table(spark, path, schemas.OEE_METRICS))
    got = tables.read_hourly(spark, hourly)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_an_interrupted_publication_leaves_summary_and_changes_in_step(spark, tmp_path):
    path = f"{tmp_path}/oee"
    tables.upsert_oee_metrics(path, metrics(spark, [(60, "LINE-A", 0.5)]), batch=0)
    tables.settle(spark, path, folders.names(spark, f"{path}__changed"))
    staged = metrics(spark, [(60, "LINE-A", 0.5), (120, "LINE-A", 0.2)]).withColumn("hour", tables.hour_of(F.col("time")))
    fitted = tables.fit(staged, schemas.OEE_METRICS, "hour")
    fitted.write.parquet(f"{path}__staged/batch=lost/merged")
    tables.upsert_oee_metrics(path, metrics(spark, [(7200, "LINE-A", 0.7)]), batch=1)
    summary = {r.hour: (r.rows, float(r.oee_low)) for r in tables.read_summary(spark, path, schemas.OEE_METRICS).collect()}
    assert summary == {"2024-03-15-08": (2, 0.2), "2024-03-15-10": (1, 0.7)}
    assert sorted(tables.changed_hours(spark, path)) == ["2024-03-15-08", "2024-03-15-10"]


def test_repeated_deliveries_count_once(spark, tmp_path):
    rows = [cycle(i, event_id=f"e{i}") for i in range(40)] + [cycle(i, event_id=None) for i in range(40, 50)]
    first = rows + rows[::2] + [cycle(50, event_id=None, units_produced=3)]
    second = rows[30:] + [cycle(55, event_id="e0"), cycle(58, event_id="new")]
    for number, part in enumerate((first, second, [cycle(900, event_id="z")], [cycle(901, event_id="y")])):
        line_frame(spark, part).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
    feed = feeds.file_feed(spark, f"{tmp_path}/in", LINE_LAYOUT, recursiveFileLookup="true", maxFilesPerTrigger="1")
    found = {}
    for distinct in (True, False):
        path = f"{tmp_path}/{distinct}"
        jobs.run_oee(feed, f"{path}/table", f"{path}/checkpoint", distinct=distinct, once=True).awaitTermination()
        found[distinct] = tables.read_table(spark, f"{path}/table", schemas.OEE_METRICS).orderBy("time").first().total_units
    want = oee_by_window(line_frame(spark, rows + [cycle(50, units_produced=3), cycle(58)])).first().total_units
    assert found[True] == want == 513 and found[False] > want
