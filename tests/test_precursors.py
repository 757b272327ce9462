from __future__ import annotations

import random

import pytest
from support import at, fault, status, status_frame

from millwright.operators.precursors import fault_precursors


def alerts(spark, *rows, **options):
    return fault_precursors(status_frame(spark, list(rows)), **options).orderBy("timestamp").collect()


HOT = {"temperature_c": 97.5}

# readings and faults, then the seconds at which an alert is due
CASES = {
    "hot, then a fault": ([status(3, **HOT), fault(21)], [21]),
    "shaking, then a fault": ([status(3, vibration_hz=120.5), fault(4)], [4]),
    "at the limits, not above": ([status(3, temperature_c=85.0), status(4, vibration_hz=120.0), fault(8)], []),
    "half a minute before": ([status(1, **HOT), fault(31)], [31]),
    "a moment more than that": ([status(1, **HOT), fault(31.001)], []),
    "calm before the fault": ([status(1), fault(2)], []),
    "two machines, each its own": (
        [status(0, equipment_id="M1", **HOT), fault(2, equipment_id="M2"), status(3, equipment_id="M2", **HOT),
         fault(9, equipment_id="M1"), fault(12, equipment_id="M2")],
        [9, 12],
    ),
    "calm in between": ([status(0, **HOT), status(6), fault(14)], [14]),
}


@pytest.mark.parametrize("rows, due", CASES.values(), ids=list(CASES))
def test_due_alerts(spark, rows, due):
    found = alerts(spark, *rows)
    assert [r.timestamp.timestamp() for r in found] == [at(second).timestamp() for second in due]
    assert {(r.alert_type, r.severity) for r in found} <= {("THERMAL_FAULT_PRECURSOR", "HIGH")}


def test_alert_uses_up_the_reading(spark):
    assert len(alerts(spark, status(0, **HOT), fault(5), fault(10))) == 1


def test_benign_readings_between_change_nothing(spark):
    assert len(alerts(spark, status(0, **HOT), status(5), status(9), fault(10))) == 1


def test_later_reading_replaces_the_earlier(spark):
    (row,) = alerts(spark, status(0, temperature_c=99.0), status(20, temperature_c=88.0), fault(40))
    assert row.temperature_c == 88.0


def test_hot_fault_does_not_arm(spark):
    assert alerts(spark, fault(0, **HOT), fault(5)) == []


def test_stale_reading_is_used_up_by_a_fault(spark):
    assert alerts(spark, status(0, **HOT), fault(31), fault(32)) == []


def test_missing_sensors_read_as_zero(spark):
    (row,) = alerts(spark, status(0, temperature_c=None, vibration_hz=121.0), fault(5))
    assert row.temperature_c == 0.0


@pytest.mark.parametrize("slot_s", [30, 60, 300, 86_400])
def test_any_slot_length_gives_the_same_alerts(spark, slot_s):
    rng = random.Random(slot_s)
    rows, clock = [], 0.0
    for i in range(1500):
        clock += rng.choice([0, 0.5, 3, 10, 29, 30, 31])
        kind = rng.random()
        machine = "EQ-HOT" if rng.random() < 0.7 else "EQ-B"
        changes = {"equipment_id": machine, "event_id": f"{i:06d}"}
        if kind < 0.3:
            rows.append(fault(clock, temperature_c=rng.choice([70.0, 95.0]), **changes))
        elif kind < 0.7:
            rows.append(status(clock, temperature_c=round(86 + rng.random() * 9, 2), **changes))
        else:
            rows.append(status(clock, **changes))
    armed, want = {}, []
    for r in rows:  # already in (time, id) order
        machine = r["equipment_id"]
        if r["status"] == "FAULT":
            before = armed.pop(machine, None)
            if before and (r["ts"] - before["ts"]).total_seconds() <= 30:
                want.append((r["event_id"], before["temperature_c"]))
        elif r["temperature_c"] > 85:
            armed[machine] = r
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = alerts(spark, *shuffled, slot_s=slot_s)
    assert sorted((r.event_id, r.temperature_c) for r in found) == sorted(want)
    assert len(want) > 100
