"""Builders of event rows and frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

BASE = datetime(2024, 3, 15, 8, 0, 0, tzinfo=timezone.utc)
DATA = "/root/testdata/sf0.001"


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


LINE_LAYOUT = (
    "event_id string, ts timestamp, line_id string, work_unit_id string, shift string, event_type string, "
    "units_produced int, units_rejected int, ideal_cycle_time_ms int, actual_cycle_time_ms int, "
    "planned_production_time_s int, downtime_s int"
)
STATUS_LAYOUT = (
    "event_id string, ts timestamp, equipment_id string, line_id string, status string, "
    "previous_status string, temperature_c double, vibration_hz double, power_kw double, "
    "fault_code string, downtime_reason string, planned_downtime boolean"
)
QUALITY_LAYOUT = (
    "event_id string, ts timestamp, batch_id string, line_id string, work_unit_id string, shift string, "
    "units_inspected int, units_passed int, units_failed int, defect_rate_pct double, yield_pct double, "
    "measured_mean double, measured_stddev double, spec_upper double, spec_lower double, cpk double, "
    "defect_type string"
)


def cycle(second: float = 0, **changes) -> dict:
    row = {
        "event_id": "cycle",
        "ts": at(second),
        "line_id": "LINE-A",
        "work_unit_id": "WU-01",
        "shift": "MORNING",
        "event_type": "CYCLE_COMPLETE",
        "units_produced": 10,
        "units_rejected": 0,
        "ideal_cycle_time_ms": 4800,
        "actual_cycle_time_ms": 4800,
        "planned_production_time_s": 3600,
        "downtime_s": 0,
    }
    return {**row, **changes}


def status(second: float = 0, **changes) -> dict:
    row = {
        "event_id": f"reading-{second:09.3f}",
        "ts": at(second),
        "equipment_id": "LINE-A-WU-01",
        "line_id": "LINE-A",
        "status": "RUNNING",
        "previous_status": "RUNNING",
        "temperature_c": 61.5,
        "vibration_hz": 47.0,
        "power_kw": 8.25,
        "fault_code": None,
        "downtime_reason": "NONE",
        "planned_downtime": False,
    }
    return {**row, **changes}


def fault(second: float, **changes) -> dict:
    return status(second, **{"status": "FAULT", "fault_code": "E-042", **changes})


def batch(second: float = 0, **changes) -> dict:
    row = {
        "event_id": f"batch-{second:09.3f}",
        "ts": at(second),
        "batch_id": "lot-7",
        "line_id": "LINE-A",
        "work_unit_id": "WU-01",
        "shift": "MORNING",
        "units_inspected": 80,
        "units_passed": 78,
        "units_failed": 2,
        "defect_rate_pct": 2.5,
        "yield_pct": 97.5,
        "measured_mean": 10.02,
        "measured_stddev": 0.0125,
        "spec_upper": 10.05,
        "spec_lower": 9.95,
        "cpk": 0.8,
        "defect_type": "NONE",
    }
    return {**row, **changes}


def frame(spark, rows: list[dict], layout: str):
    names = [part.split()[0] for part in layout.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], layout)


def line_frame(spark, rows):
    return frame(spark, rows, LINE_LAYOUT)


def status_frame(spark, rows):
    return frame(spark, rows, STATUS_LAYOUT)


def batch_frame(spark, rows):
    return frame(spark, rows, QUALITY_LAYOUT)
