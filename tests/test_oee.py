from __future__ import annotations

import pytest
from support import cycle, line_frame

from millwright.operators.oee import oee_against_target, oee_by_window

COLUMNS = [
    "time",
    "line_id",
    "availability",
    "performance",
    "quality",
    "oee",
    "total_units",
    "good_units",
]


def rate(spark, *rows, **options):
    found = oee_by_window(line_frame(spark, list(rows)), **options).collect()
    assert len(found) == 1
    return found[0]


def stop(seconds, kind="STOP", **changes):
    return cycle(event_type=kind, units_produced=0, downtime_s=seconds, **changes)


# rows, then availability, performance, quality, effectiveness, units and good units, worked out by hand
CASES = {
    "line A at its rate for part of the hour": (
        [cycle(units_produced=200, units_rejected=4), cycle(units_produced=160, units_rejected=5)],
        (1.0, 0.48, 0.975, 0.468, 360, 351),
    ),
    "line B stopped for a quarter of the hour": (
        [cycle(line_id="LINE-B", units_produced=290, units_rejected=29), stop(900, line_id="LINE-B")],
        (0.75, 0.6659, 0.9, 0.4495, 290, 261),
    ),
    "line C faster than it can run": (
        [cycle(line_id="LINE-C", units_produced=600)]
        + [stop(n, kind, line_id="LINE-C") for n, kind in ((1200, "CHANGEOVER"), (600, "PLANNED_STOP"))],
        (0.5, 1.0, 1.0, 0.5, 600, 600),
    ),
    "a fault and nothing made": ([stop(36, "FAULT")], (0.99, 0.0, 0.0, 0.0, 0, 0)),
    "units noted on a fault do not count": (
        [cycle(event_type="FAULT", units_produced=1, downtime_s=1440), cycle(units_produced=224)],
        (0.6, 0.4978, 1.0, 0.2987, 224, 224),
    ),
    "downtime noted on other events": (
        [cycle(units_produced=75, units_rejected=30, downtime_s=500), stop(700, "START")],
        (1.0, 0.1, 0.6, 0.06, 75, 45),
    ),
    "everything rejected": ([cycle(units_produced=15, units_rejected=15)], (1.0, 0.02, 0.0, 0.0, 15, 0)),
}


@pytest.mark.parametrize("rows, want", CASES.values(), ids=list(CASES))
def test_rates(spark, rows, want):
    row = rate(spark, *rows)
    assert (row.availability, row.performance, row.quality, row.oee, row.total_units, row.good_units) == want
    assert list(row.asDict()) == COLUMNS


def test_lines_and_windows_do_not_mix(spark):
    rows = [
        cycle(second, line_id=line, units_produced=units)
        for second, line, units in ((0, "LINE-B", 3), (59, "LINE-B", 4), (60, "LINE-B", 5), (1, "LINE-C", 6))
    ]
    found = oee_by_window(line_frame(spark, rows)).orderBy("line_id", "time").collect()
    assert [(r.line_id, r.total_units) for r in found] == [("LINE-B", 7), ("LINE-B", 5), ("LINE-C", 6)]


def test_downtime_beyond_planned_time(spark):
    row = rate(spark, cycle(event_type="STOP", downtime_s=4000), cycle(units_produced=10))
    assert (row.availability, row.performance, row.oee) == (0.0, 1.0, 0.0)


def test_unknown_line_uses_the_default_cycle(spark):
    row = rate(spark, cycle(line_id="LINE-X", units_produced=360))
    assert row.performance == 0.5


def test_missing_line(spark):
    assert rate(spark, cycle(line_id=None)).line_id == "UNKNOWN"


def test_rejects_above_output_give_negative_quality(spark):
    assert rate(spark, cycle(units_produced=10, units_rejected=15)).quality == -0.5


def test_window_without_cycles_keeps_its_row(spark):
    row = rate(spark, cycle(event_type="START"))
    assert (row.total_units, row.quality, row.oee) == (0, 0.0, 0.0)


def test_missing_numbers_count_as_zero(spark):
    row = rate(
        spark, cycle(units_rejected=None), cycle(event_type="FAULT", downtime_s=None, units_produced=None)
    )
    assert (row.availability, row.total_units, row.good_units) == (1.0, 10, 10)


def test_windows_are_half_open_and_named_by_their_end(spark):
    rows = [cycle(0), cycle(59.999), cycle(60)]
    found = oee_by_window(line_frame(spark, rows)).orderBy("time").collect()
    assert [(r.time.minute, r.total_units) for r in found] == [(1, 20), (2, 10)]


def test_downtime_types_are_a_parameter(spark):
    stop = cycle(event_type="STOP", downtime_s=600)
    assert rate(spark, stop, downtime_types=("FAULT",)).availability == 1.0


def test_target_gap(spark):
    rows = [cycle(units_produced=750), cycle(line_id="LINE-X")]
    found = oee_against_target(oee_by_window(line_frame(spark, rows))).collect()
    assert [(r.line_id, r.gap, r.on_target) for r in found] == [("LINE-A", 0.13, True)]
