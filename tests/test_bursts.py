from __future__ import annotations

import random
from datetime import timedelta

from support import LINE_LAYOUT, STATUS_LAYOUT, at, cycle, fault, line_frame, status, status_frame
from test_streaming import arrivals, collect, stream
from pyspark.sql import functions as F

from millwright.operators import bursts, rollups
from millwright.streaming import jobs, progress


def brute(rows, gap):
    found = []
    for machine in sorted({r["equipment_id"] or "UNKNOWN" for r in rows}):
        times = sorted(r["ts"] for r in rows if (r["equipment_id"] or "UNKNOWN") == machine and r["status"] == "FAULT")
        run = []
        for ts in [*times, None]:
            if run and (ts is None or ts - run[-1] > timedelta(seconds=gap)):
                if len(run) > 1:
                    found.append((machine, run[0], run[-1], len(run)))
                run = []
            run.append(ts)
    return found


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        machine = {"equipment_id": rng.choice(["M1", "M1", "M2", None]), "event_id": f"{i:04d}"}
        second = rng.randrange(20_000)
        rows.append(fault(second, **machine) if rng.random() < 0.5 else status(second, **machine))
    return rows + [fault(30_000, event_id="x"), fault(30_060, event_id="y"), fault(30_121, event_id="z")]


def plain(df):
    return sorted((r.equipment_id, r.started, r.last, r.faults) for r in df.collect())


def test_bursts_and_the_readings_inside(spark):
    rows = random_rows(1)
    want = brute(rows, 60)
    utc = [(m, a.replace(tzinfo=None), b.replace(tzinfo=None), n) for m, a, b, n in want]
    table = status_frame(spark, rows)
    assert plain(bursts.fault_bursts(table, 60)) == utc and (utc[0][3] > 1)
    inside = {
        r["event_id"]
        for r in rows
        if any(m == (r["equipment_id"] or "UNKNOWN") and a <= r["ts"] <= b for m, a, b, _ in want)
    }
    clashing = table.withColumns({"started": F.lit("mine"), "of": F.lit(1)})
    got = bursts.in_bursts(clashing, bursts.fault_bursts(table, 60))
    assert got.columns == [*clashing.columns, "in_burst"] and got.count() == len(rows)
    assert {r.event_id for r in got.filter("in_burst").collect()} == inside
    assert {r.started for r in got.collect()} == {"mine"}


def test_bursts_of_a_stream(spark, tmp_path):
    rows = sorted(random_rows(2), key=lambda r: r["ts"])
    rows += [status(90_000, equipment_id="M9")]
    files = [rows[i * len(rows) // 5 : (i + 1) * len(rows) // 5] for i in range(5)]
    folder = arrivals(f"{tmp_path}/in", [status_frame(spark, f) for f in files])
    feed = stream(spark, folder, STATUS_LAYOUT).withWatermark("ts", "45 seconds")
    got = collect(bursts.fault_bursts(feed, 60), str(tmp_path))
    assert plain(got) == plain(bursts.fault_bursts(status_frame(spark, rows), 60))


def test_latency_sketches_merge_within_their_error(spark):
    rng = random.Random(5)
    delays = [int(rng.expovariate(1 / 800)) + (rng.random() < 0.02) * rng.randrange(10_000_000) for _ in range(30_000)]
    rows = [(at(i % 20_000), at(i % 20_000) + timedelta(milliseconds=d), "LINE-A") for i, d in enumerate(delays)]
    events = spark.createDataFrame(rows, "ts timestamp, ingested_at timestamp, line_id string").repartition(6)
    sketches = rollups.latency_sketches(events)
    assert sketches.count() == 6 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    found = rollups.latency_from_sketches(sketches).first()
    delays.sort()
    for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        low, high = delays[int((p - 0.01) * 30_000)], delays[min(29_999, int((p + 0.01) * 30_000))]
        assert low <= found[name] <= high
    assert found.events == 30_000 and rollups.latency_from_sketches(sketches, "line_id").count() == 1


def test_progress_is_kept(spark, tmp_path):
    parts = [[cycle(0), cycle(5)], [cycle(600)], [cycle(601)], [cycle(1), cycle(602)]]
    folder = arrivals(f"{tmp_path}/in", [line_frame(spark, p) for p in parts])
    with progress.ProgressLog(spark, f"{tmp_path}/progress", every=2):
        feed = stream(spark, folder, LINE_LAYOUT)
        jobs.run_oee(feed, f"{tmp_path}/table", f"{tmp_path}/cp", name="lines", once=True).awaitTermination()
    rows = progress.read_progress(spark, f"{tmp_path}/progress")
    report = progress.progress_report(rows).first()
    assert (report.query, report.rows_in, report.late_rows) == ("lines", 6, 1)
    assert report.batches >= 4 and 0 < report.checkpoint_p95_ms < report.batch_p95_ms * 2
    assert rows.filter("lag_ms >= 0").count() >= 3 and progress.read_progress(spark, f"{tmp_path}/none").count() == 0
