"""The three plant feeds, derived from a generic ``events`` table.

The supplied test data has no manufacturing tables. These views map its event
log onto the contracts with plain column arithmetic, one output row per input
row at most, so every query built on them reads the whole table.

``pace`` is the factor by which event time is compressed: at 240 thirty days
become three hours, dense enough for 60-second windows. Shift-based queries use
``pace=1`` to see the full calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
DENSE = 240

EVENT_LOG = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

_SHIFT = """CASE WHEN hour(ts) >= 6 AND hour(ts) < 14 THEN 'MORNING'
    WHEN hour(ts) >= 14 AND hour(ts) < 22 THEN 'AFTERNOON' ELSE 'NIGHT' END AS shift"""
_IDEAL_MS = "decode(line_id, 'LINE-A', 4800, 'LINE-B', 6200, 'LINE-C', 3500, 5000)"


def _pick(*names: str, by: str) -> str:
    """One of a few names by position, as a SQL expression."""
    cases = "".join(f" WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {by}{cases} END"


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_LOG).parquet(f"{sf_dir}/events.parquet")


def _base(events: DataFrame, pace: int) -> DataFrame:
    us = f"{EPOCH_US} + (unix_micros(cast(ts AS timestamp)) - {EPOCH_US}) div {pace}"
    return events.selectExpr(
        "event_id",
        f"timestamp_micros({us}) AS ts",
        "event_type AS kind",
        "event_type NOT IN ('error', 'signup') AS is_cycle",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "cast(floor(value * 100 + 0.5D) AS bigint) AS v",
        _pick("LINE-A", "LINE-B", "LINE-C", "LINE-D", by="user_id % 4") + " AS line_id",
        "concat('WU-0', cast((user_id div 4) % 5 + 1 AS string)) AS work_unit_id",
    )


def line_events(events: DataFrame, pace: int = DENSE) -> DataFrame:
    stop = _pick("START", "STOP", "CHANGEOVER", "PLANNED_STOP", by="k % 4")
    return _base(events, pace).selectExpr(
        "event_id",
        "ts",
        "timestamp_micros(unix_micros(ts) + (v * 37) % 5000 * 1000) AS ingested_at",
        "'1.0' AS schema_version",
        "'PLANT-1' AS site_id",
        "'ASSEMBLY' AS area_id",
        "line_id",
        "work_unit_id",
        _SHIFT,
        f"CASE kind WHEN 'error' THEN 'FAULT' WHEN 'signup' THEN {stop} ELSE 'CYCLE_COMPLETE' END "
        "AS event_type",
        "cast(if(is_cycle, v % 16, 0) AS int) AS units_produced",
        "cast(if(is_cycle, least(v % 16, k % 3), 0) AS int) AS units_rejected",
        f"{_IDEAL_MS} AS ideal_cycle_time_ms",
        f"cast({_IDEAL_MS} + v % 1201 - 600 AS int) AS actual_cycle_time_ms",
        "27000 AS planned_production_time_s",
        "cast(if(is_cycle, k, v % 120) AS int) AS downtime_s",
    )


def equipment_status(events: DataFrame, pace: int = DENSE) -> DataFrame:
    pause = _pick("IDLE", "MAINTENANCE", "CHANGEOVER", "STARTUP", by="k % 4")
    reason = _pick(
        "MECHANICAL_FAILURE",
        "ELECTRICAL_FAULT",
        "MATERIAL_SHORTAGE",
        "OPERATOR_ABSENCE",
        "QUALITY_HOLD",
        by="k % 5",
    )
    code = _pick(
        "E-042",
        "E-043",
        "E-101",
        "E-102",
        "E-201",
        "E-202",
        "E-250",
        "E-301",
        "E-401",
        "E-501",
        "E-502",
        "E-999",
        by="k % 12",
    )
    with_status = _base(events, pace).selectExpr(
        "*", f"CASE kind WHEN 'error' THEN 'FAULT' WHEN 'signup' THEN {pause} ELSE 'RUNNING' END AS status"
    )
    return with_status.selectExpr(
        "event_id",
        "ts",
        "'1.0' AS schema_version",
        "concat_ws('-', line_id, work_unit_id) AS equipment_id",
        "line_id",
        "work_unit_id",
        "status",
        f"if(k % 19 = 0, 'OFFLINE', {_pick('RUNNING', 'IDLE', 'UNKNOWN', by='k % 3')}) AS previous_status",
        f"""CASE status WHEN 'FAULT' THEN {reason} WHEN 'MAINTENANCE' THEN 'PLANNED_MAINTENANCE'
            WHEN 'CHANGEOVER' THEN 'CHANGEOVER' ELSE 'NONE' END AS downtime_reason""",
        "status IN ('MAINTENANCE', 'CHANGEOVER') AS planned_downtime",
        "if(k % 17 <> 0, (v % 4500 + 5500) / 100D, null) AS temperature_c",
        "(v * 7 % 12000 + 3000) / 100D AS vibration_hz",
        "(v * 3 % 500 + 800) / 100D AS power_kw",
        f"CASE WHEN status = 'FAULT' THEN {code} END AS fault_code",
    )


def quality_metrics(events: DataFrame, pace: int = DENSE) -> DataFrame:
    defect = _pick(
        "DIMENSIONAL", "SURFACE_FINISH", "ASSEMBLY_ERROR", "WEIGHT", "COSMETIC", "SCRATCH", by="k % 6"
    )

    def percent(part: str) -> str:
        return f"if(units_inspected > 0, floor({part} / units_inspected * 100 * 100D + 0.5D) / 100D, 0D)"

    measured = (
        _base(events, pace)
        .filter("kind IN ('purchase', 'view')")
        .selectExpr(
            "*",
            "if(k % 23 = 0, 0, k % 20 + 50) AS units_inspected",
            "(decode(line_id, 'LINE-B', 250000, 'LINE-C', 50000, 100000) + v % 1001 - 500) / 10000D "
            "AS measured_mean",
            "(v * 3 % 400) / 10000D AS measured_stddev",
            "decode(line_id, 'LINE-B', 25.10D, 'LINE-C', 5.025D, 10.05D) AS spec_upper",
            "decode(line_id, 'LINE-B', 24.90D, 'LINE-C', 4.975D, 9.95D) AS spec_lower",
        )
        .selectExpr(
            "*",
            "cast(least(v % 4, units_inspected) AS int) AS units_failed",
            """if(measured_stddev > 0, least((spec_upper - measured_mean) / (3D * measured_stddev),
                (measured_mean - spec_lower) / (3D * measured_stddev)), 0D) AS own_cpk""",
        )
    )
    return measured.selectExpr(
        "event_id",
        "ts",
        "'1.0' AS schema_version",
        "concat('BATCH-', cast(event_id AS string)) AS batch_id",
        "line_id",
        "work_unit_id",
        _SHIFT,
        "units_inspected",
        "units_inspected - units_failed AS units_passed",
        "units_failed",
        f"{percent('units_failed')} + if(k % 29 = 0, 1D, 0D) AS defect_rate_pct",
        f"if(units_failed = 0, 'NONE', {defect}) AS defect_type",
        f"{percent('(units_inspected - units_failed)')} AS yield_pct",
        "spec_upper",
        "spec_lower",
        "measured_mean",
        "measured_stddev",
        "floor(own_cpk * 1000D + 0.5D) / 1000D + if(k % 31 = 0, 0.5D, 0D) AS cpk",
    )
