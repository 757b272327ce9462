from __future__ import annotations

import random

import pytest
from support import at, cycle, fault, line_frame, status, status_frame

from millwright.operators.enrich import repair_against_expected
from millwright.operators.intervals import repair_time_by_line, status_intervals
from millwright.operators.losses import six_big_losses


def intervals_of(spark, *rows, **options):
    found = status_intervals(status_frame(spark, list(rows)), **options)
    return found.orderBy("equipment_id", "started").collect()


def test_repeated_status_is_one_interval(spark):
    found = intervals_of(spark, status(0), status(10), fault(20), status(50))
    assert [(r.status, r.seconds) for r in found] == [
        ("RUNNING", 20.0),
        ("FAULT", 30.0),
        ("RUNNING", None),
    ]


@pytest.mark.parametrize("slot_s", [60, 3600, 86_400])
def test_intervals_across_slots(spark, slot_s):
    rng = random.Random(7)
    rows, clock = [], 0.0
    for i in range(1200):
        clock += rng.choice([1, 20, 61, 200, 4000])
        rows.append(
            status(
                clock,
                event_id=f"{i:06d}",
                equipment_id=rng.choice(["EQ-A", "EQ-A", "EQ-B"]),
                status=rng.choice(["RUNNING", "RUNNING", "RUNNING", "IDLE", "FAULT"]),
            )
        )
    want = []
    for machine in ("EQ-A", "EQ-B"):
        changes = []
        for r in rows:
            if r["equipment_id"] == machine and (not changes or changes[-1][0] != r["status"]):
                changes.append((r["status"], r["ts"]))
        for i, (name, start) in enumerate(changes):
            end = changes[i + 1][1] if i + 1 < len(changes) else None
            want.append((machine, name, start.timestamp(), end and end.timestamp()))
    mixed = rows[:]
    rng.shuffle(mixed)
    found = [
        (r.equipment_id, r.status, r.started.timestamp(), r.ended and r.ended.timestamp())
        for r in intervals_of(spark, *mixed, slot_s=slot_s)
    ]
    assert found == want


def test_repair_time(spark):
    rows = [status(0), fault(60), status(180), fault(240), status(300), fault(400)]
    frame = status_frame(spark, rows)
    (row,) = repair_time_by_line(status_intervals(frame)).collect()
    assert (row.repairs, row.mttr_minutes) == (2, 1.5)


def test_repair_against_expected(spark):
    rows = [
        fault(0, downtime_reason="QUALITY_HOLD"),
        status(600),
        fault(700, downtime_reason="SOMETHING_NEW"),
        status(760),
    ]
    frame = status_frame(spark, rows)
    found = repair_against_expected(status_intervals(frame, carry=["downtime_reason"])).collect()
    assert {(r.downtime_reason, r.actual_minutes, r.expected_minutes) for r in found} == {
        ("QUALITY_HOLD", 10.0, 60),
        ("SOMETHING_NEW", 1.0, 30),
    }


def test_six_big_losses(spark):
    events = [
        cycle(0, event_type="FAULT", downtime_s=120),
        cycle(1, event_type="CHANGEOVER", downtime_s=30),
        cycle(2, units_rejected=3, actual_cycle_time_ms=5000),
        # 14:00, the start of a shift
        cycle(6 * 3600 + 60, units_rejected=2),
    ]
    states = [status(0, status="IDLE"), status(301), status(400, status="IDLE"), status(700)]
    (row,) = six_big_losses(line_frame(spark, events), status_frame(spark, states)).collect()
    assert row.asDict() == {
        "line_id": "LINE-A",
        "equipment_failure_s": 120,
        "setup_s": 30,
        "idle_stops": 1,
        "idle_s": 301.0,
        "reduced_speed_ms": 200,
        "process_defects": 3,
        "startup_rejects": 2,
    }
    assert at(0).hour == 8
