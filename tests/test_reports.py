from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pyarrow.parquet as parquet
import pytest
from support import at, batch, batch_frame, cycle, fault, line_frame, status, status_frame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.clock import in_changeover, in_cold_start, shift_of, shift_start
from millwright.functions.numeric import band, oee_class, round_metric
from millwright.operators import bounded, charts, enrich, rollups
from millwright.plans import register, serving
from millwright.sources import plant_views

AS_OF = datetime(2024, 3, 15, 9, 0)


def metric_frame(spark, rows):
    return spark.createDataFrame(rows, "time timestamp, line_id string, oee double, availability double, "
                                       "performance double, quality double, total_units bigint")


def alert_frame(spark, rows):
    return spark.createDataFrame(
        [(at(s), e, line, "T", sev, 90.0, "E-042", ack, f"{s}") for s, e, line, sev, ack in rows],
        "timestamp timestamp, equipment_id string, line_id string, alert_type string, severity string, "
        "temperature_c double, fault_code string, acknowledged boolean, event_id string",
    )


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "x, places, want", [(0.83333, 4, 0.8333), (0.00005, 4, 0.0001), (-0.5, 4, -0.5), (1.005, 1, 1.0)]
)
def test_round_metric(spark, x, places, want):
    assert value(spark, round_metric(F.lit(x), places)) == want


@pytest.mark.parametrize("x, want", [(-3, "red"), (59.99, "red"), (60, "yellow"), (85, "green")])
def test_band_bounds_are_inclusive(spark, x, want):
    assert value(spark, band(F.lit(float(x)), schemas.OEE_STEPS)) == want


@pytest.mark.parametrize("x, want", [(85.1, "World Class"), (85, "Typical"), (40, "Low"), (39.9, "Poor")])
def test_oee_class(spark, x, want):
    assert value(spark, oee_class(F.lit(float(x)))) == want


@pytest.mark.parametrize(
    "clock, shift, start",
    [
        ("2024-03-15 06:00:00", "MORNING", "2024-03-15 06:00:00"),
        ("2024-03-15 13:59:59", "MORNING", "2024-03-15 06:00:00"),
        ("2024-03-15 14:00:00", "AFTERNOON", "2024-03-15 14:00:00"),
        ("2024-03-15 22:00:00", "NIGHT", "2024-03-15 22:00:00"),
        ("2024-03-16 05:59:59", "NIGHT", "2024-03-15 22:00:00"),
    ],
)
def test_shifts(spark, clock, shift, start):
    ts = F.lit(clock).cast("timestamp")
    assert value(spark, shift_of(ts)) == shift
    assert value(spark, shift_start(ts).cast("string")) == start


def test_calendar_flags(spark):
    def flags(clock):
        ts = F.lit(clock).cast("timestamp")
        return value(spark, in_changeover(ts)), value(spark, in_cold_start(ts))

    assert flags("2024-03-18 05:46:00") == (True, True)  # a Monday
    assert flags("2024-03-18 05:45:59") == (False, True)
    assert flags("2024-03-19 14:14:59") == (True, False)
    assert flags("2024-03-19 14:15:00") == (False, False)


def test_hourly_rollup_and_refresh(spark):
    rows = [
        (at(60 * m), "LINE-A", 0.1 * (m % 3), 1.0, 1.0, 1.0, 1) for m in (-200, -130, -100, -40, 0, 30)
    ]
    hourly = rollups.oee_hourly(metric_frame(spark, rows)).orderBy("bucket").collect()
    assert [r.bucket.hour for r in hourly] == [4, 5, 6, 7, 8]
    refreshed = rollups.refreshed_hours(metric_frame(spark, rows), AS_OF).collect()
    assert sorted(r.bucket.hour for r in refreshed) == [6, 7]  # 08 to 09 ends after 08:59


def test_time_between_failures(spark):
    rows = [(0, "E", "LINE-A", "HIGH", False), (3600, "E", "LINE-A", "HIGH", False),
            (1800, "E", "LINE-A", "HIGH", True), (10, "E", "LINE-B", "HIGH", False),
            (-8 * 86400, "E", "LINE-A", "HIGH", False)]
    found = {r.line_id: r.mtbf_hours for r in rollups.failure_gaps(alert_frame(spark, rows), AS_OF).collect()}
    assert found == {"LINE-A": 0.5, "LINE-B": None}


def test_alert_panels(spark):
    rows = [(0, "E1", "LINE-A", "LOW", False), (5, "E2", "LINE-B", "HIGH", False),
            (9, "E3", "LINE-A", "HIGH", False), (3, "E4", "LINE-A", "HIGH", True)]
    alerts = alert_frame(spark, rows)
    assert serving.open_alert_count(alerts).first().asDict() == {"alerts": 3, "band": "orange"}
    assert serving.open_alert_count(alerts.filter("acknowledged")).first().band == "green"
    assert serving.alert_count(alerts, AS_OF).first().asDict() == {"alerts": 4, "band": "green"}
    assert [r.Equipment for r in serving.active_alerts(alerts, 2).collect()] == ["E3", "E2"]
    assert [r.equipment_id for r in serving.alerts_by_severity(alerts).collect()] == ["E3", "E2", "E1"]


def test_latest_and_newest(spark):
    rows = [(at(0), "LINE-A", 0.9, 1.0, 1.0, 1.0, 1), (at(60), "LINE-A", 0.5, 1.0, 1.0, 1.0, 1),
            (at(0), "LINE-B", 0.7, 1.0, 1.0, 1.0, 1)]
    metrics = metric_frame(spark, rows)
    now = {r.line_id: (r.oee_pct, r.band) for r in serving.current_oee(metrics).collect()}
    assert now == {"LINE-A": (50.0, "red"), "LINE-B": (70.0, "yellow")}
    assert [r.line_id for r in rollups.at_newest_time(metrics).collect()] == ["LINE-A"]
    assert [r.Line for r in serving.worst_windows(metrics, limit=2).collect()] == ["LINE-A", "LINE-B"]
    wide = serving.wide(serving.trend(metrics, "oee", factor=100), "oee", ["LINE-A", "LINE-B"])
    assert [tuple(r)[1:] for r in wide.orderBy("time").collect()] == [(90.0, 70.0), (50.0, None)]
    one = serving.trend(metrics, "oee", start=at(30), line_id="LINE-A").collect()
    assert [r.oee for r in one] == [0.5]


def test_low_lines(spark):
    rows = [(datetime(2024, 3, 15, 8, 59, tzinfo=timezone.utc), line, oee, 1.0, 1.0, 1.0, 1)
            for line, oee in (("LINE-A", 0.59), ("LINE-B", 0.6))]
    low = rollups.low_oee_lines(metric_frame(spark, rows), AS_OF).collect()
    assert [(r.line_id, r.avg_oee) for r in low] == [("LINE-A", 0.59)]


def test_production_quality_skips_unknown_and_empty_lines(spark):
    rows = [cycle(units_produced=40, units_rejected=4), cycle(line_id="LINE-X"),
            cycle(line_id="LINE-B", event_type="FAULT"), cycle(line_id="LINE-C", units_produced=0)]
    found = rollups.production_quality(line_frame(spark, rows)).orderBy("line_id").collect()
    assert [(r.line_id, r.batches, r.total_units, r.quality) for r in found] == [
        ("LINE-A", 1, 40, 0.9),
        ("LINE-C", 1, 0, 0.0),
    ]


def test_batch_mismatches(spark):
    good = batch(0, batch_id="GOOD")
    bad = batch(1, batch_id="BAD", yield_pct=90.0)
    empty = batch(2, batch_id="EMPTY", units_inspected=0, units_failed=0, defect_rate_pct=0.0, yield_pct=0.0)
    found = enrich.quality_mismatches(batch_frame(spark, [good, bad, empty])).collect()
    assert [tuple(r) for r in found] == [("BAD", "LINE-A", "yield_pct", 90.0, 97.5)]


def test_fault_codes_and_domains(spark):
    rows = [
        fault(0, downtime_reason="QUALITY_HOLD", fault_code="E-501"),
        fault(1, downtime_reason="QUALITY_HOLD", fault_code="E-042"),
        fault(2, downtime_reason="NONE", fault_code="E-999"),
        fault(3, downtime_reason="QUALITY_HOLD", fault_code="E-999"),
        status(4, previous_status="BROKEN"),
        status(5, status=None),
    ]
    frame = status_frame(spark, rows)
    bad = enrich.invalid_fault_codes(frame).collect()
    assert {(r.downtime_reason, r.fault_code) for r in bad} == {
        ("QUALITY_HOLD", "E-042"),
        ("QUALITY_HOLD", "E-999"),
    }
    outside = enrich.domain_violations(frame, "equipment_status").collect()
    assert {(r.column, r.value, r.rows) for r in outside} == {
        ("previous_status", "BROKEN", 1),
        ("status", None, 1),
    }


def test_control_limits(spark):
    rows = [batch(i, batch_id=f"B{i}", measured_mean=10.0 + (0.01 if i % 2 else -0.01)) for i in range(20)]
    rows.append(batch(4000, batch_id="OUT", measured_mean=10.2))
    found = {r.batch_id: r for r in charts.xbar_chart(batch_frame(spark, rows)).collect()}
    import statistics

    values = [r["measured_mean"] for r in rows]
    assert found["B0"].ucl == pytest.approx(statistics.mean(values) + 3 * statistics.stdev(values), abs=6e-5)
    assert [b for b, r in found.items() if r.out_of_control] == ["OUT"]


def test_summary_join_has_a_way_without_broadcast(spark):
    rows = spark.range(100).withColumn("key", F.col("id") % 5)
    summary = rows.groupBy("key").count()
    small = bounded.join_summary(rows, summary, ["key"])
    large = bounded.join_summary(rows, summary, ["key"], max_rows=3)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(small)
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
    assert sorted(small.collect()) == sorted(large.collect())


def test_shift_reports(spark):
    rows = [cycle(h * 3600, units_produced=100) for h in (-9, -1, 0, 7, 15)]
    by_shift = enrich.oee_by_shift(line_frame(spark, rows))
    assert {(r["shift"], r.total_units) for r in by_shift.collect()} == {
        ("AFTERNOON", 100), ("MORNING", 200), ("NIGHT", 100), }  | {("NIGHT", 100)}
    assert enrich.last_shifts(by_shift, 2).count() == 2
    passed = charts.shift_yield(batch_frame(spark, [batch(0), batch(-3 * 3600)]), AS_OF).collect()
    assert [(r.line_id, r["shift"], r.yield_pct) for r in passed] == [("LINE-A", "MORNING", 97.5)]


def test_the_wide_trend_shows_every_window_of_the_table(spark, tmp_path):
    """Also those more than two hours before the newest event."""
    begin = datetime(2024, 1, 1)
    days = [begin + timedelta(days=d) for d in (0, 10, 29)]
    rows = [(i, ts, 0, "click", 5.0, '{"k": 1}') for i, ts in enumerate(days)]
    events = spark.createDataFrame(rows, plant_views.EVENT_LOG)
    parquet.write_table(events.toArrow(), f"{tmp_path}/events.parquet")
    got = register.oee_trend_wide(spark, str(tmp_path)).orderBy("time").collect()
    dense = [begin + timedelta(minutes=1 + d * 24 * 60 // 240) for d in (0, 10, 29)]
    assert [r.time.replace(tzinfo=None) for r in got] == dense
    assert all(r["LINE-A"] is not None and r["LINE-B"] is None for r in got)
