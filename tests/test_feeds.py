from __future__ import annotations

import json

from support import cycle, line_frame
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millwright.plans.check_sql import statements
from millwright.plans.register import registered
from millwright.sources.feeds import decode, normalize, rejects, text_feed, with_defaults


def decoded(spark, table, *payloads):
    return decode(spark.createDataFrame([(p,) for p in payloads], "payload string"), table)


def test_numbers_may_be_text_and_fields_may_be_missing(spark):
    found = decoded(
        spark,
        "line_events",
        json.dumps({"event_id": "a", "timestamp": "2024-03-15T08:00:00+00:00", "units_produced": "7"}),
        json.dumps({"event_id": "b", "timestamp": "2024-03-15T10:00:00+02:00", "units_produced": 7.9}),
        json.dumps({"event_id": "c", "timestamp": "nonsense", "units_produced": "many", "extra": {"x": 1}}),
        json.dumps({"event_id": "d", "units_produced": 3_000_000_000, "line_id": None}),
    )
    rows = {r.event_id: r for r in with_defaults(found, "line_events").collect()}
    assert [rows[k].units_produced for k in "abcd"] == [7, 7, 0, 0]
    assert rows["a"].ts == rows["b"].ts
    assert rows["c"].ts is None and rows["c"].timestamp == "nonsense"
    assert (rows["d"].line_id, rows["d"].schema_version, rows["d"].downtime_s) == ("UNKNOWN", "1.0", 0)


def test_malformed_messages_are_skipped(spark):
    good = json.dumps({"event_id": "a"})
    found = decoded(spark, "line_events", "{", "", None, "not json", good)
    assert [r.event_id for r in found.collect()] == ["a"]


def test_skipped_messages_and_misfits_are_counted(spark):
    payloads = [
        "{",
        json.dumps({"event_id": "a", "downtime_s": "x"}),
        json.dumps({"event_id": "b"}),
        json.dumps({"event_id": "c", "timestamp": "yesterday", "units_produced": "1"}),
    ]
    messages = spark.createDataFrame([(p,) for p in payloads], "payload string")
    counts = Observation()
    assert len(decode(messages, "line_events", counts=counts).collect()) == 3
    assert counts.get == {"records": 4, "malformed": 1, "misfits": 2, "timeless": 2}
    reasons = [(r.payload, r.reason) for r in rejects(messages, "line_events").collect()]
    assert reasons == list(zip(payloads, ["malformed", "no time", "no time", "unreadable time"]))


def test_booleans_and_measurements(spark):
    payload = {"event_id": "a", "planned_downtime": "false", "temperature_c": "85.1", "vibration_hz": None}
    (row,) = decoded(spark, "equipment_status", json.dumps(payload)).collect()
    assert (row.planned_downtime, row.temperature_c, row.vibration_hz) == (False, 85.1, None)


def test_normalize_keeps_the_contract_only(spark):
    rows = line_frame(spark, [cycle()]).withColumn("noise", F.lit(1)).drop("units_rejected")
    found = normalize(rows, "line_events")
    assert "noise" not in found.columns
    row = found.first()
    assert row.units_rejected is None and row.units_produced == 10 and row.ingested_at is not None
    assert found.select("ingested_at").distinct().count() == 1
    assert row.timestamp == "2024-03-15T08:00:00.000000+00:00"
    assert normalize(found, "line_events").first().timestamp == row.timestamp


def test_text_feed_reads_lines(spark, tmp_path):
    (tmp_path / "part.json").write_text('{"event_id": "a"}\n{"event_id": "b"}\nbroken\n')
    found = decode(text_feed(spark, str(tmp_path), streaming=False), "quality_metrics")
    assert sorted(r.event_id for r in found.collect()) == ["a", "b"]
    assert text_feed(spark, str(tmp_path)).isStreaming


def test_every_query_has_sql():
    assert set(registered()) == set(statements())
