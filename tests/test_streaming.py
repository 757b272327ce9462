from __future__ import annotations

import os
import random

import pandas as pd
import pyarrow.parquet as parquet
import pytest
from support import (
    LINE_LAYOUT,
    QUALITY_LAYOUT,
    STATUS_LAYOUT,
    batch,
    batch_frame,
    cycle,
    fault,
    line_frame,
    status,
    status_frame,
)

from millwright import schemas
from millwright.operators.capability import rolling_cpk
from millwright.operators.oee import oee_by_window
from millwright.operators.intervals import status_intervals
from millwright.operators.precursors import fault_precursors
from millwright.sinks import archive, tables
from millwright.sources.feeds import file_feed
from millwright.streaming import jobs, ordered_state


def arrivals(folder, frames):
    """Writes each frame as one file, to arrive in order."""
    os.makedirs(folder, exist_ok=True)
    for number, df in enumerate(frames):
        part = f"{folder}/part-{number:03d}.parquet"
        parquet.write_table(df.toArrow(), part)
        os.utime(part, (1_700_000_000 + number, 1_700_000_000 + number))
    return str(folder)


def stream(spark, folder, layout):
    return file_feed(spark, folder, layout, maxFilesPerTrigger="1")


def collect(stream_df, path):
    """Runs a stream to its end and returns everything it emitted."""
    spark = stream_df.sparkSession
    query = jobs.run(
        stream_df,
        lambda rows, run, n: rows.write.mode("overwrite").parquet(f"{path}/out/batch={n}"),
        f"{path}/checkpoint",
        once=True,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("batch")


def in_parts(rows, parts):
    return [rows[i::parts] if parts > len(rows) else rows[i * len(rows) // parts : (i + 1) * len(rows) // parts]
            for i in range(parts)]


@pytest.mark.parametrize("newest, kept", [(103, True), (106, False)])
def test_late_rows_at_the_watermark(spark, tmp_path, newest, kept):
    """A row 44 s late still counts, one 47 s late does not.

    A micro-batch judges lateness by the watermark its predecessor started with,
    hence the batch without late rows in between.
    """
    quiet = [cycle(newest, event_type="START")]
    files = [[cycle(0)], [cycle(newest)], quiet, [cycle(59, units_produced=7)], [cycle(600)]]
    folder = arrivals(f"{tmp_path}/in", [line_frame(spark, f) for f in files])
    events = stream(spark, folder, LINE_LAYOUT)
    found = collect(jobs.oee_stream(events), str(tmp_path)).orderBy("time").collect()
    assert found[0].total_units == (17 if kept else 10)
    assert found[1].total_units == 10


def test_oee_stream_equals_batch(spark, tmp_path):
    rng = random.Random(1)
    rows = [
        cycle(
            i * 3 + rng.random() * 20,
            event_id=str(i),
            line_id=rng.choice(["LINE-A", "LINE-A", "LINE-B", "LINE-Z"]),
            event_type=rng.choice(["CYCLE_COMPLETE", "CYCLE_COMPLETE", "FAULT", "STOP"]),
            downtime_s=rng.randrange(40),
        )
        for i in range(400)
    ]
    rows.append(cycle(5000, event_id="last"))
    folder = arrivals(f"{tmp_path}/in", [line_frame(spark, p) for p in in_parts(rows, 6)])
    events = stream(spark, folder, LINE_LAYOUT)
    got = collect(jobs.oee_stream(events), str(tmp_path))
    want = oee_by_window(line_frame(spark, rows[:-1]))
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_cpk_stream_equals_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [
        batch(
            i * 5 + rng.random() * 30,
            event_id=f"{i:04d}",
            line_id=rng.choice(["LINE-A", "LINE-B"]),
            measured_mean=round(10 + rng.random() / 100, 4),
            measured_stddev=rng.choice([0.0, 0.01, 0.02]),
        )
        for i in range(300)
    ]
    files = [*in_parts(rows, 5), [batch(9000)], [batch(9001)]]
    folder = arrivals(f"{tmp_path}/in", [batch_frame(spark, f) for f in files])
    got = collect(jobs.cpk_stream(stream(spark, folder, QUALITY_LAYOUT)), str(tmp_path))
    want = rolling_cpk(batch_frame(spark, rows))
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_alert_stream_equals_batch_for_shuffled_input(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        machine = {"equipment_id": rng.choice(["EQ-A", "EQ-A", "EQ-B"]), "event_id": f"{i:05d}"}
        second = i * 2 + rng.choice([0, 0.25])
        kind = rng.random()
        if kind < 0.25:
            rows.append(fault(second, temperature_c=rng.choice([60.0, 99.0]), **machine))
        elif kind < 0.5:
            rows.append(status(second, temperature_c=round(86 + rng.random(), 2), **machine))
        elif kind < 0.55:
            rows.append(status(second, temperature_c=None, vibration_hz=150.0, **machine))
        else:
            rows.append(status(second, **machine))
    arrival = sorted(rows, key=lambda r: r["ts"].timestamp() + rng.random() * 40)
    files = [*in_parts(arrival, 9), [status(5000, equipment_id="EQ-Z", event_id="y")],
             [status(6000, equipment_id="EQ-Z", event_id="z")]]
    folder = arrivals(f"{tmp_path}/in", [status_frame(spark, f) for f in files])
    path = str(tmp_path)
    query = jobs.run_alerts(
        stream(spark, folder, STATUS_LAYOUT), f"{path}/alerts", f"{path}/checkpoint", once=True
    )
    query.awaitTermination()
    want = fault_precursors(status_frame(spark, rows))
    columns = ["timestamp", "equipment_id", "temperature_c", "fault_code"]
    got = tables.read_alerts(spark, f"{path}/alerts")
    got = got.withColumn("temperature_c", got.temperature_c.cast("double"))
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())
    assert want.count() > 80


def test_restart_continues_where_the_last_run_stopped(spark, tmp_path):
    path = str(tmp_path)
    first = [cycle(i * 10, event_id=str(i)) for i in range(30)]
    second = [cycle(300 + i * 10, event_id=f"n{i}") for i in range(30)] + [cycle(5000)]
    for n, rows in enumerate((first, second)):
        part = f"{path}/in/part-{n}.parquet"
        os.makedirs(f"{path}/in", exist_ok=True)
        parquet.write_table(line_frame(spark, rows).toArrow(), part)
        events = stream(spark, f"{path}/in", LINE_LAYOUT)
        jobs.run_oee(events, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    table = tables.read_table(spark, f"{path}/table", schemas.OEE_METRICS)
    assert table.count() == 10 and table.agg({"total_units": "sum"}).first()[0] == 600


def test_archive_stream_makes_one_snapshot_per_batch(spark, tmp_path):
    path = str(tmp_path)
    files = [[cycle(i * 100 + j, event_id=f"{i}-{j}") for j in range(5)] for i in range(3)]
    folder = arrivals(f"{path}/in", [line_frame(spark, f) for f in files])
    events = stream(spark, folder, LINE_LAYOUT)
    jobs.run_archive(events, f"{path}/archive", "line_events", f"{path}/cp", once=True).awaitTermination()
    log = archive.snapshots(spark, f"{path}/archive", "line_events").orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.added_records) for r in log] == [(0, 5), (1, 5), (2, 5)]
    assert archive.scan(spark, f"{path}/archive", "line_events", as_of_snapshot=1).count() == 10


def test_interval_stream_equals_batch_for_shuffled_input(spark, tmp_path):
    rng = random.Random(9)
    rows = [
        status(
            i * 4 + rng.random() * 30,
            event_id=f"{i:05d}",
            equipment_id=rng.choice(["M1", "M1", "M1", "M2", None]),
            status=rng.choice(["RUNNING", "RUNNING", "IDLE", "FAULT", None]),
        )
        for i in range(500)
    ]
    files = [*in_parts(rows, 7), [status(90_000, equipment_id="M9")], [status(90_001, equipment_id="M9")]]
    folder = arrivals(f"{tmp_path}/in", [status_frame(spark, f) for f in files])
    got = collect(ordered_state.interval_stream(stream(spark, folder, STATUS_LAYOUT)), str(tmp_path))
    want = status_intervals(status_frame(spark, rows)).filter("ended is not null")
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect()) and want.count() > 100


def test_an_open_interval_outlives_a_restart(spark, tmp_path):
    path = str(tmp_path)
    parts = [[status(0, status="IDLE"), status(5, status="IDLE")], [status(400, status="IDLE")], [status(7200, status="FAULT")], [status(90_000)]]
    for n in range(len(parts)):
        arrivals(f"{path}/in", [status_frame(spark, p) for p in parts[: n + 1]])
        feed = stream(spark, f"{path}/in", STATUS_LAYOUT)
        jobs.run_intervals(feed, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()
    found = spark.read.parquet(f"{path}/table").orderBy("started").collect()
    assert [(r.status, r.seconds) for r in found] == [("IDLE", 7200.0)]


def test_an_arming_reading_is_forgotten_by_timer(spark, tmp_path):
    """The memory of a machine's slot goes when no fault can follow any more; rows that wait stay."""
    path = str(tmp_path)
    hot = [status(0, temperature_c=95.0), status(700, equipment_id="M2", temperature_c=95.0)]
    arrivals(f"{path}/in", [status_frame(spark, hot), status_frame(spark, [status(1, equipment_id="M3")])])
    feed = stream(spark, f"{path}/in", STATUS_LAYOUT)

    def run():
        jobs.run_alerts(feed, f"{path}/table", f"{path}/checkpoint", once=True).awaitTermination()

    def states(name):
        reader = spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", name)
        reader = reader.option("flattenCollectionTypes", "true") if name == "waiting" else reader
        return {row["key"]["equipment_id"] for row in reader.load().select("key").collect()}

    run()
    assert states("waiting") == {"M2"} and states("memory") == set()
    arrivals(f"{path}/in", [status_frame(spark, [])] * 2 + [status_frame(spark, [status(740, equipment_id="M2")])])
    arrivals(f"{path}/more", [status_frame(spark, [status(760)])])
    os.rename(f"{path}/more/part-000.parquet", f"{path}/in/part-003.parquet")
    run()
    assert states("waiting") == set() and states("memory") == {"M2"}
    arrivals(f"{path}/more", [status_frame(spark, [status(900)])])
    os.rename(f"{path}/more/part-000.parquet", f"{path}/in/part-004.parquet")
    run()
    assert states("memory") == set()


class Kept:
    """A state variable, as the operator sees it."""

    def __init__(self):
        self.values = {}

    def getValue(self, key):
        return self.values.get(key)

    def updateValue(self, key, value):
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]

    def iterator(self):
        return iter(list(self.values.items()))

    def exists(self):
        return None in self.values

    def get(self):
        return self.values[None]

    def update(self, value):
        self.values[None] = value

    def clear(self):
        self.values.pop(None, None)


class Handle:
    def __init__(self):
        self.kept, self.timers = {}, []

    def getMapState(self, name, key, value):
        return self.kept.setdefault(name, Kept())

    def getValueState(self, name, layout):
        return self.kept.setdefault(name, Kept())

    def registerTimer(self, ms):
        self.timers.append(ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_large_batch_of_one_machine_is_held_by_the_slot(monkeypatch):
    """Rows come and go in frames of bounded size, and one slot is taken from the state at a time."""
    monkeypatch.setattr(ordered_state, "DEALT_ROWS", 500)
    monkeypatch.setattr(ordered_state, "OUT_ROWS", 100)
    hours, each = 40, 60
    rng = random.Random(4)
    rows = [(h * 3_600_000_000 + i * 60_000_000, h * each + i, "", "L", "ab"[i % 2]) for h in range(hours) for i in range(each)]
    rng.shuffle(rows)
    names = ["us", "event_key", "event_id", "line_id", "status"]
    machine, handle = ordered_state.Intervals(), Handle()
    machine.init(handle)
    read = []

    def frames():
        for at in range(0, len(rows), 100):
            read.append(sum(len(part[0]) for part in handle.kept["waiting"].values.values()))
            yield pd.DataFrame(rows[at : at + 100], columns=names)

    assert list(machine.handleInputRows(("M",), frames(), Clock(0))) == []
    # what was read before is in the state by then, but for the rows dealt together
    assert all(at * 100 - held <= 500 for at, held in enumerate(read))
    most, take = [], machine._taken
    monkeypatch.setattr(machine, "_taken", lambda *slot: most.append(len(found := take(*slot))) or found)
    out = list(machine.handleExpiredTimer(("M",), Clock(10 * 3_600_000 + 90_000), None))
    assert max(most) == each and max(len(frame) for frame in out) == 100
    # ten whole hours and the first two rows of the next
    assert sum(len(frame) for frame in out) == 10 * each + 1
    out += list(machine.handleExpiredTimer(("M",), Clock(hours * 3_600_000), None))
    found = pd.concat(out)
    assert len(found) == hours * each - 1 and list(found.ended_us - found.started_us) == [60_000_000] * len(found)
    assert handle.kept["waiting"].values == {} and handle.kept["slots"].values == {}
    assert handle.timers == [1, 10 * 3_600_000 + 120_000 + 1]
