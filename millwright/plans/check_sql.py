"""The registered queries restated in plain SQL, for comparison on another engine.

The statements are written from the definitions, not from the Spark code: they
use windows, generated window ends and ordered lookups freely, since they only
run on small tables.
"""

from __future__ import annotations

_EPOCH = 1704067200000000


def _round(x: str, places: int) -> str:
    return f"floor(({x}) * 1e{places} + 5e-1) / 1e{places}"


def _mean(x: str, places: int) -> str:
    """The average of a stored figure, which has so many decimals by its type."""
    return f"CAST(sum(CAST(round({x} * 1e{places}) AS BIGINT)) AS DOUBLE) / (count({x}) * 1e{places})"


def _fine_mean(x: str) -> str:
    """The average of a measurement; its sum is taken in decimals, so that it depends on no order."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38, 12))) * 1000000000000 AS DOUBLE) / (count({x}) * 1e12)"


def _ts(us: str) -> str:
    return f"make_timestamp(CAST({us} AS BIGINT))"


def _shift(us: str) -> str:
    hour = f"(({us}) // 3600000000) % 24"
    return (
        f"CASE WHEN {hour} BETWEEN 6 AND 13 THEN 'MORNING' "
        f"WHEN {hour} BETWEEN 14 AND 21 THEN 'AFTERNOON' ELSE 'NIGHT' END"
    )


def _shift_start(us: str) -> str:
    return f"((({us}) - 21600000000) // 28800000000) * 28800000000 + 21600000000"


_IDEAL = (
    "CASE line_id WHEN 'LINE-A' THEN 4800 WHEN 'LINE-B' THEN 6200 WHEN 'LINE-C' THEN 3500 ELSE 5000 END"
)
_BAND_OEE = "CASE WHEN {x} >= 85 THEN 'green' WHEN {x} >= 60 THEN 'yellow' ELSE 'red' END"


def _feeds(clock: str) -> dict[str, str]:
    """The plant views; ``clock`` gives the event time in microseconds."""
    return {
        "base": f"""
SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(round(value * 100) AS BIGINT) AS v, {clock} AS us,
       ['LINE-A', 'LINE-B', 'LINE-C', 'LINE-D'][user_id % 4 + 1] AS line_id,
       'WU-0' || CAST((user_id // 4) % 5 + 1 AS VARCHAR) AS work_unit_id
FROM events""",
        "line_events": f"""
SELECT event_id, us, us + (v * 37) % 5000 * 1000 AS ingested_us, line_id, work_unit_id,
       {_shift('us')} AS shift,
       CASE kind WHEN 'error' THEN 'FAULT'
                 WHEN 'signup' THEN ['START', 'STOP', 'CHANGEOVER', 'PLANNED_STOP'][k % 4 + 1]
                 ELSE 'CYCLE_COMPLETE' END AS event_type,
       CASE WHEN kind IN ('error', 'signup') THEN 0 ELSE v % 16 END AS units_produced,
       CASE WHEN kind IN ('error', 'signup') THEN 0 ELSE least(v % 16, k % 3) END AS units_rejected,
       {_IDEAL} AS ideal_ms, {_IDEAL} + v % 1201 - 600 AS actual_ms,
       CASE WHEN kind IN ('error', 'signup') THEN v % 120 ELSE k END AS downtime_s
FROM base""",
        "equipment_status": """
SELECT event_id, us, line_id || '-' || work_unit_id AS equipment_id, line_id, work_unit_id, status,
       CASE WHEN k % 19 = 0 THEN 'OFFLINE' ELSE ['RUNNING', 'IDLE', 'UNKNOWN'][k % 3 + 1] END
           AS previous_status,
       CASE status WHEN 'FAULT' THEN ['MECHANICAL_FAILURE', 'ELECTRICAL_FAULT', 'MATERIAL_SHORTAGE',
                                      'OPERATOR_ABSENCE', 'QUALITY_HOLD'][k % 5 + 1]
                   WHEN 'MAINTENANCE' THEN 'PLANNED_MAINTENANCE'
                   WHEN 'CHANGEOVER' THEN 'CHANGEOVER' ELSE 'NONE' END AS downtime_reason,
       status IN ('MAINTENANCE', 'CHANGEOVER') AS planned_downtime,
       CASE WHEN k % 17 <> 0 THEN (v % 4500 + 5500) / 1e2 END AS temperature_c,
       (v * 7 % 12000 + 3000) / 1e2 AS vibration_hz,
       (v * 3 % 500 + 800) / 1e2 AS power_kw,
       CASE WHEN status = 'FAULT' THEN
           ['E-042', 'E-043', 'E-101', 'E-102', 'E-201', 'E-202', 'E-250', 'E-301', 'E-401', 'E-501',
            'E-502', 'E-999'][k % 12 + 1] END AS fault_code
FROM (SELECT *, CASE kind WHEN 'error' THEN 'FAULT'
                          WHEN 'signup' THEN ['IDLE', 'MAINTENANCE', 'CHANGEOVER', 'STARTUP'][k % 4 + 1]
                          ELSE 'RUNNING' END AS status FROM base)""",
        "measured": """
SELECT event_id, us, line_id, k, v,
       CASE WHEN k % 23 = 0 THEN 0 ELSE k % 20 + 50 END AS units_inspected,
       (CASE line_id WHEN 'LINE-B' THEN 250000 WHEN 'LINE-C' THEN 50000 ELSE 100000 END
           + v % 1001 - 500) / 1e4 AS measured_mean,
       (v * 3 % 400) / 1e4 AS measured_stddev,
       CASE line_id WHEN 'LINE-B' THEN 25.10e0 WHEN 'LINE-C' THEN 5.025e0 ELSE 10.05e0 END AS spec_upper,
       CASE line_id WHEN 'LINE-B' THEN 24.90e0 WHEN 'LINE-C' THEN 4.975e0 ELSE 9.95e0 END AS spec_lower
FROM base WHERE kind IN ('purchase', 'view')""",
        "quality_metrics": f"""
SELECT *, 'BATCH-' || CAST(event_id AS VARCHAR) AS batch_id, {_shift('us')} AS shift,
       units_inspected - units_failed AS units_passed,
       true_defect_rate + CASE WHEN k % 29 = 0 THEN 1e0 ELSE 0e0 END AS defect_rate_pct,
       true_cpk + CASE WHEN k % 31 = 0 THEN 5e-1 ELSE 0e0 END AS cpk,
       CASE WHEN units_failed = 0 THEN 'NONE'
            ELSE ['DIMENSIONAL', 'SURFACE_FINISH', 'ASSEMBLY_ERROR', 'WEIGHT', 'COSMETIC', 'SCRATCH']
                 [k % 6 + 1] END AS defect_type
FROM (SELECT *,
        CASE WHEN units_inspected > 0 THEN {_round('units_failed / units_inspected * 100', 2)}
             ELSE 0e0 END AS true_defect_rate,
        CASE WHEN units_inspected > 0
             THEN {_round('(units_inspected - units_failed) / units_inspected * 100', 2)}
             ELSE 0e0 END AS true_yield,
        {_round('''CASE WHEN measured_stddev > 0 THEN least(
            (spec_upper - measured_mean) / (3e0 * measured_stddev),
            (measured_mean - spec_lower) / (3e0 * measured_stddev)) ELSE 0e0 END''', 3)} AS true_cpk
      FROM (SELECT *, least(v % 4, units_inspected) AS units_failed FROM measured))""",
    }


def _capability(batches: str, mean) -> str:
    return f"""
SELECT time_us, line_id, {_round('''CASE WHEN upper > lower
          THEN least((upper - m) / (3e0 * s), (m - lower) / (3e0 * s)) ELSE 0e0 END''', 3)} AS rolling_cpk,
       {_round('m', 4)} AS rolling_mean, {_round('s', 4)} AS rolling_stddev, n AS window_batches
FROM (SELECT time_us, line_id, count(*) AS n, {mean('measured_mean')} AS m, {mean('positive')} AS s,
             last(spec_upper ORDER BY us, event_id) AS upper,
             last(spec_lower ORDER BY us, event_id) AS lower
      FROM (SELECT *, (us // 60000000 + i) * 60000000 AS time_us,
                   CASE WHEN measured_stddev > 0 THEN measured_stddev END AS positive
            FROM {batches}, unnest(range(1, 11)) AS r(i))
      GROUP BY 1, 2)
WHERE n >= 2 AND s IS NOT NULL"""


def _oee(events: str, width_us: int, planned: int = 3600, kinds: str | None = None) -> str:
    kinds = kinds or "'FAULT', 'STOP', 'PLANNED_STOP', 'CHANGEOVER'"
    return f"""
SELECT time_us, line_id, {_round('a', 4)} AS availability, {_round('p', 4)} AS performance,
       {_round('q', 4)} AS quality, {_round('a * p * q', 4)} AS oee, t AS total_units, g AS good_units
FROM (SELECT *, greatest(0e0, ({planned} - d) / {planned}) AS a,
             CASE WHEN t > 0 THEN least(1e0, t * {_IDEAL} / greatest(1, ({planned} - d) * 1000))
                  ELSE 0e0 END AS p,
             CASE WHEN t > 0 THEN g / t ELSE 0e0 END AS q
      FROM (SELECT (us // {width_us} + 1) * {width_us} AS time_us, line_id,
                   CAST(sum(CASE WHEN event_type IN ({kinds}) THEN downtime_s ELSE 0 END) AS BIGINT) AS d,
                   CAST(sum(CASE WHEN event_type = 'CYCLE_COMPLETE' THEN units_produced ELSE 0 END)
                        AS BIGINT) AS t,
                   CAST(sum(CASE WHEN event_type = 'CYCLE_COMPLETE'
                                 THEN units_produced - units_rejected ELSE 0 END) AS BIGINT) AS g
            FROM {events} GROUP BY 1, 2))"""


_DERIVED = {
    "now": "SELECT max(us) AS us FROM base",
    "closed": "SELECT us // 1000 * 1000 - 45000000 AS us FROM now",
    "metrics": _oee("line_events", 60_000_000),
    "stats": _capability("quality_metrics", _fine_mean),
    "alerts": """
SELECT us, equipment_id, line_id, 'THERMAL_FAULT_PRECURSOR' AS alert_type, 'HIGH' AS severity,
       before_temperature AS temperature_c, fault_code, event_id,
       fault_code < 'E-200' AND us // 60000000 % 5 <> 0 AS acknowledged
FROM (SELECT *, lag(status) OVER w AS before_status, lag(us) OVER w AS before_us,
             lag(coalesce(temperature_c, 0e0)) OVER w AS before_temperature
      FROM equipment_status
      WHERE status = 'FAULT' OR coalesce(temperature_c, 0) > 85 OR coalesce(vibration_hz, 0) > 120
      WINDOW w AS (PARTITION BY equipment_id ORDER BY us, event_id))
WHERE status = 'FAULT' AND before_status <> 'FAULT' AND us - before_us <= 30000000""",
    "hourly": f"""
SELECT time_us // 3600000000 * 3600000000 AS bucket_us, line_id, {_mean('oee', 4)} AS avg_oee,
       min(oee) AS min_oee, max(oee) AS max_oee, {_mean('availability', 4)} AS avg_availability,
       {_mean('performance', 4)} AS avg_performance, {_mean('quality', 4)} AS avg_quality
FROM metrics GROUP BY 1, 2""",
    "intervals": """
SELECT equipment_id, line_id, status, us AS start_us,
       lead(us) OVER (PARTITION BY equipment_id ORDER BY us, event_id) AS end_us
FROM (SELECT *, lag(status) OVER (PARTITION BY equipment_id ORDER BY us, event_id) AS before
      FROM equipment_status)
WHERE before IS NULL OR before <> status""",
    "shifts": f"""
SELECT line_id, shift, shift_us, {_round('a', 4)} AS availability, {_round('p', 4)} AS performance,
       {_round('q', 4)} AS quality, {_round('a * p * q', 4)} AS oee, t AS total_units, g AS good_units
FROM (SELECT *, greatest(0e0, (27000 - d) / 27000) AS a,
             CASE WHEN t > 0 THEN least(1e0, t * {_IDEAL} / greatest(1, (27000 - d) * 1000))
                  ELSE 0e0 END AS p,
             CASE WHEN t > 0 THEN g / t ELSE 0e0 END AS q
      FROM (SELECT line_id, shift, {_shift_start('us')} AS shift_us,
                   CAST(sum(CASE WHEN event_type IN ('FAULT', 'STOP', 'PLANNED_STOP', 'CHANGEOVER')
                                 THEN downtime_s ELSE 0 END) AS BIGINT) AS d,
                   CAST(sum(CASE WHEN event_type = 'CYCLE_COMPLETE' THEN units_produced ELSE 0 END)
                        AS BIGINT) AS t,
                   CAST(sum(CASE WHEN event_type = 'CYCLE_COMPLETE'
                                 THEN units_produced - units_rejected ELSE 0 END) AS BIGINT) AS g
            FROM line_events GROUP BY 1, 2, 3))""",
}

_DENSE = {**_feeds(f"{_EPOCH} + (epoch_us(ts) - {_EPOCH}) // 240"), **_DERIVED}
_CALENDAR = {**_feeds("epoch_us(ts)"), **_DERIVED}


def _statement(body: str, views: dict[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views.items()) + "\n" + body


def _dense(body: str) -> str:
    return _statement(body, _DENSE)


def _calendar(body: str) -> str:
    return _statement(body, _CALENDAR)


_RATES = "availability, performance, quality, oee, total_units, good_units"
_METRIC_ROWS = f"SELECT {_ts('time_us')} AS time, line_id, {_RATES} FROM "
_STAT_ROWS = (
    f"SELECT {_ts('time_us')} AS time, line_id, rolling_cpk, rolling_mean, rolling_stddev, "
    "window_batches FROM stats"
)
_ALERT_ROWS = (
    f"SELECT {_ts('us')} AS timestamp, equipment_id, line_id, alert_type, severity, temperature_c, "
    "fault_code, false AS acknowledged FROM alerts"
)
_BURST_SPANS = """
SELECT equipment_id, min(us) AS first_us, max(us) AS last_us, count(*) AS faults
FROM (SELECT equipment_id, us, sum(opens) OVER (PARTITION BY equipment_id ORDER BY us, event_id) AS number
      FROM (SELECT equipment_id, us, event_id,
                   CASE WHEN us - lag(us) OVER (PARTITION BY equipment_id ORDER BY us, event_id) <= 120000000
                        THEN 0 ELSE 1 END AS opens
            FROM equipment_status WHERE status = 'FAULT'))
GROUP BY equipment_id, number HAVING count(*) > 1"""
_BURSTS = (
    f"SELECT equipment_id, {_ts('first_us')} AS started, {_ts('last_us')} AS last, faults FROM ({_BURST_SPANS})"
)
_HOURLY_ROWS = (
    f"SELECT {_ts('bucket_us')} AS bucket, line_id, avg_oee, min_oee, max_oee, avg_availability, "
    "avg_performance, avg_quality FROM hourly"
)
_HOURS = "3600000000"
_FINE = """(SELECT us, event_id, line_id, spec_upper, spec_lower,
       measured_mean + (event_id % 9973) / 1e7 AS measured_mean,
       measured_stddev / 100 + (event_id % 9973) / 1e9 AS measured_stddev FROM quality_metrics)"""
_SNAPSHOT = "CASE WHEN us < 1704931200000000 THEN 1 WHEN us < 1705795200000000 THEN 2 ELSE 3 END"
_ARCHIVED = (
    f"SELECT CAST(event_id AS VARCHAR) AS event_id, {_ts('us')} AS ts, line_id, event_type, "
    f"CAST(units_produced AS INTEGER) AS units_produced, CAST({_SNAPSHOT} AS BIGINT) AS snapshot_id "
    "FROM line_events"
)


_BY_MINUTE = _ARCHIVED.replace(_SNAPSHOT, "us // 60000000 % 3 + 1")


def _decoded(table: str, columns: str, tag: str) -> str:
    return _dense(
        f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {_ts('us')} AS ts,
       CASE WHEN {tag} % 7 <> 0 THEN line_id ELSE 'UNKNOWN' END AS line_id, '1.0' AS schema_version, {columns}
FROM {table} WHERE {tag} % 13 <> 0"""
    )


def _limits(value: str) -> str:
    """Per line: center and three-sigma limits."""
    return f"""
limits AS (
  SELECT line_id, {_round('c', 4)} AS center, {_round('c + 3 * s', 4)} AS ucl, {_round('c - 3 * s', 4)} AS lcl
  FROM (SELECT line_id, {_fine_mean(value)} AS c, stddev_samp({value}) AS s FROM quality_metrics GROUP BY 1))"""


def statements() -> dict[str, str]:
    found = {
        "oee_by_window": _dense(_METRIC_ROWS + "metrics"),
        "oee_by_hour_window": _dense(_METRIC_ROWS + f"({_oee('line_events', 3_600_000_000)})"),
        "oee_fault_downtime_only": _dense(
            _METRIC_ROWS + f"({_oee('line_events', 60_000_000, 1800, chr(39) + 'FAULT' + chr(39))})"
        ),
        "rolling_cpk": _dense(_STAT_ROWS),
        "rolling_cpk_fine": _dense(
            f"""SELECT {_ts('time_us')} AS time, line_id, rolling_cpk, rolling_mean, rolling_stddev, window_batches
FROM ({_capability(_FINE, 'avg({})'.format)})"""
        ),
        "fault_precursors": _dense(
            f"SELECT {_ts('us')} AS timestamp, equipment_id, line_id, alert_type, severity, "
            "temperature_c, fault_code, event_id FROM alerts"
        ),
        "oee_against_target": _dense(
            f"""SELECT {_ts('time_us')} AS time, line_id, oee, target AS target_oee,
       {_round('oee - target', 4)} AS gap, oee >= target AS on_target
FROM metrics JOIN (VALUES ('LINE-A', 87e-2), ('LINE-B', 82e-2), ('LINE-C', 79e-2)) t(line_id, target)
USING (line_id)"""
        ),
        "oee_hourly_rollup": _dense(_HOURLY_ROWS),
        "oee_hourly_refresh": _dense(
            _HOURLY_ROWS + f""" , now WHERE bucket_us >= now.us - 3 * {_HOURS}
  AND bucket_us + {_HOURS} <= now.us - 60000000"""
        ),
        "daily_oee": _calendar(
            f"""SELECT {_ts('time_us // 86400000000 * 86400000000')} AS time, line_id,
       {_mean('oee', 4)} * 100 AS oee_pct FROM metrics GROUP BY 1, 2"""
        ),
        "alerts_per_hour": _dense(
            f"SELECT {_ts(f'us // {_HOURS} * {_HOURS}')} AS time, line_id, count(*) AS alerts "
            "FROM alerts GROUP BY 1, 2"
        ),
        "alerts_last_day": _dense(
            f"""SELECT n AS alerts, CASE WHEN n >= 20 THEN 'red' WHEN n >= 5 THEN 'yellow' ELSE 'green' END AS band
FROM (SELECT count(*) AS n FROM alerts WHERE us > (SELECT us FROM now) - 24 * {_HOURS})"""
        ),
        "alerts_by_line": _dense(
            f"SELECT line_id, count(*) AS alerts FROM alerts WHERE us > (SELECT us FROM now) - 24 * {_HOURS} "
            "GROUP BY 1"
        ),
        "open_alert_count": _dense(
            """SELECT n AS alerts, CASE WHEN n >= 1 THEN 'orange' ELSE 'green' END AS band
FROM (SELECT count(*) AS n FROM alerts WHERE NOT acknowledged)"""
        ),
        "mtbf_by_line": _dense(
            f"""SELECT line_id, {_round('(max(us) - min(us)) / 1e6 / nullif(count(*) - 1, 0) / 3600', 2)}
       AS mtbf_hours
FROM alerts WHERE us > (SELECT us FROM now) - 7 * 24 * {_HOURS} GROUP BY 1"""
        ),
        "current_oee": _dense(
            f"""SELECT line_id, {_ts('time_us')} AS time, oee * 100 AS oee_pct,
       {_BAND_OEE.format(x='oee * 100')} AS band
FROM metrics QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY time_us DESC) = 1"""
        ),
        "current_oee_class": _dense(
            """SELECT line_id, oee * 100 AS oee_pct, CASE WHEN oee * 100 > 85 THEN 'World Class'
       WHEN oee * 100 >= 60 THEN 'Typical' WHEN oee * 100 >= 40 THEN 'Low' ELSE 'Poor' END AS oee_class
FROM metrics QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY time_us DESC) = 1"""
        ),
        "oee_trend_wide": _dense(
            f"SELECT {_ts('time_us')} AS time, "
            + ", ".join(
                f"max(CASE WHEN line_id = '{x}' THEN oee * 100 END) AS \"{x}\""
                for x in ("LINE-A", "LINE-B", "LINE-C")
            )
            + " FROM metrics GROUP BY 1"
        ),
        "active_alerts": _dense(
            f"""SELECT {_ts('us')} AS "Time", equipment_id AS "Equipment", line_id AS "Line",
       alert_type AS "Alert Type", severity AS "Severity", temperature_c AS "Temp °C",
       fault_code AS "Fault Code"
FROM alerts WHERE NOT acknowledged ORDER BY us DESC, equipment_id, event_id LIMIT 50"""
        ),
        "current_cpk": _dense(
            """SELECT line_id, rolling_cpk, CASE WHEN rolling_cpk >= 1.33e0 THEN 'green'
       WHEN rolling_cpk >= 1 THEN 'yellow' ELSE 'red' END AS band
FROM stats WHERE time_us = (SELECT max(time_us) FROM stats)"""
        ),
        "hourly_oee_trend": _dense(
            f"SELECT {_ts('bucket_us')} AS time, line_id, avg_oee * 100 AS oee_pct FROM hourly"
        ),
        "worst_windows": _dense(
            f"""SELECT {_ts('time_us')} AS "Time", line_id AS "Line", {_round('oee * 100', 1)} AS "OEE %",
       {_round('availability * 100', 1)} AS "Avail %", {_round('performance * 100', 1)} AS "Perf %",
       {_round('quality * 100', 1)} AS "Quality %", total_units AS "Units"
FROM metrics ORDER BY oee, time_us, line_id LIMIT 20"""
        ),
        "recent_oee_trend": _dense(
            f"SELECT {_ts('time_us')} AS time, line_id, oee FROM metrics "
            "WHERE time_us > (SELECT us FROM now) - 300000000"
        ),
        "low_oee_lines": _dense(
            f"SELECT line_id, {_mean('oee', 4)} AS avg_oee FROM metrics "
            f"WHERE time_us > (SELECT us FROM now) - 120000000 GROUP BY 1 HAVING {_mean('oee', 4)} < 6e-1"
        ),
        "alerts_by_severity": _dense(
            f"SELECT severity, {_ts('us')} AS timestamp, equipment_id, line_id, alert_type, fault_code "
            "FROM alerts WHERE NOT acknowledged"
        ),
        "oee_by_shift": _calendar(
            f"SELECT line_id, shift, {_ts('shift_us')} AS shift_start, {_RATES} FROM shifts"
        ),
        "last_three_shifts": _calendar(
            f"""SELECT line_id, shift, {_ts('shift_us')} AS shift_start, {_RATES} FROM shifts
QUALIFY dense_rank() OVER (ORDER BY shift_us DESC) <= 3"""
        ),
        "current_day_average": _calendar(
            f"""SELECT line_id, {_mean('oee', 4)} AS avg_oee, count(*) AS windows FROM metrics
WHERE time_us // 86400000000 = (SELECT us FROM now) // 86400000000 GROUP BY 1"""
        ),
        "availability_heatmap": _calendar(
            f"""SELECT line_id, time_us // {_HOURS} % 24 AS hour, {_mean('availability', 4)} AS availability
FROM metrics GROUP BY 1, 2"""
        ),
        "daily_quality": _calendar(
            f"""SELECT {_ts('us // 86400000000 * 86400000000')} AS day, line_id,
       (CAST(sum(units_produced - units_rejected) AS DOUBLE) / count(*))
       / nullif(CAST(sum(units_produced) AS DOUBLE) / count(*), 0) AS avg_quality
FROM line_events WHERE us > (SELECT us FROM now) - 30 * 24 * {_HOURS} GROUP BY 1, 2"""
        ),
        "batch_quality_mismatches": _dense(
            """SELECT batch_id, line_id, 'defect_rate_pct' AS figure, defect_rate_pct AS stored,
       true_defect_rate AS computed FROM quality_metrics WHERE k % 29 = 0
UNION ALL SELECT batch_id, line_id, 'cpk', cpk, true_cpk FROM quality_metrics WHERE k % 31 = 0"""
        ),
        "planned_downtime_split": _dense(
            """SELECT line_id,
       count(*) FILTER (downtime_reason IN ('PLANNED_MAINTENANCE', 'CHANGEOVER')) AS planned,
       count(*) FILTER (downtime_reason NOT IN ('PLANNED_MAINTENANCE', 'CHANGEOVER', 'NONE')) AS unplanned,
       count(*) FILTER ((downtime_reason IN ('PLANNED_MAINTENANCE', 'CHANGEOVER')) <> planned_downtime)
           AS flag_mismatches
FROM equipment_status GROUP BY 1"""
        ),
        "downtime_seconds_split": _dense(
            """SELECT line_id,
       CAST(coalesce(sum(downtime_s) FILTER (event_type IN ('PLANNED_STOP', 'CHANGEOVER')), 0) AS BIGINT)
           AS planned_s,
       CAST(coalesce(sum(downtime_s) FILTER (event_type IN ('FAULT', 'STOP')), 0) AS BIGINT) AS unplanned_s
FROM line_events GROUP BY 1"""
        ),
        "fault_rate_by_context": _calendar(
            f"""SELECT cold_start, changeover, hot, vibrating, count(*) AS events,
       count(*) FILTER (status = 'FAULT') AS faults,
       {_round("count(*) FILTER (status = 'FAULT') / count(*)", 4)} AS fault_rate
FROM (SELECT status, isodow({_ts('us')}) = 1 AND us // {_HOURS} % 24 < 9 AS cold_start,
             abs(us // 60000000 % 1440 - 360) < 15 OR abs(us // 60000000 % 1440 - 840) < 15
                 OR abs(us // 60000000 % 1440 - 1320) < 15 AS changeover,
             coalesce(temperature_c, 0) > 85 AS hot, coalesce(vibration_hz, 0) > 120 AS vibrating
      FROM equipment_status) GROUP BY 1, 2, 3, 4"""
        ),
        "status_intervals": _calendar(
            f"""SELECT equipment_id, line_id, status, {_ts('start_us')} AS started, {_ts('end_us')} AS ended,
       (end_us - start_us) / 1e6 AS seconds FROM intervals"""
        ),
        "stream_status_intervals": _calendar(
            f"""SELECT equipment_id, line_id, status, {_ts('start_us')} AS started, {_ts('end_us')} AS ended,
       (end_us - start_us) / 1e6 AS seconds FROM intervals WHERE end_us IS NOT NULL"""
        ),
        "mttr_by_line": _calendar(
            f"""SELECT line_id, count(*) AS repairs,
       {_round('CAST(sum(end_us - start_us) AS DOUBLE) / count(*) / 60e6', 2)} AS mttr_minutes
FROM intervals WHERE status = 'FAULT' AND end_us IS NOT NULL GROUP BY 1"""
        ),
        "repair_against_expected": _calendar(
            f"""SELECT downtime_reason, count(*) AS repairs,
       {_round('CAST(sum(end_us - start_us) AS DOUBLE) / count(*) / 60e6', 2)} AS actual_minutes,
       CASE downtime_reason WHEN 'MECHANICAL_FAILURE' THEN 45 WHEN 'ELECTRICAL_FAULT' THEN 30
            WHEN 'MATERIAL_SHORTAGE' THEN 15 WHEN 'QUALITY_HOLD' THEN 60 WHEN 'OPERATOR_ABSENCE' THEN 20
            WHEN 'PLANNED_MAINTENANCE' THEN 30 WHEN 'CHANGEOVER' THEN 25 ELSE 30 END AS expected_minutes
FROM intervals i JOIN equipment_status e
  ON e.equipment_id = i.equipment_id AND e.us = i.start_us AND e.status = 'FAULT'
WHERE i.status = 'FAULT' AND end_us IS NOT NULL GROUP BY 1"""
        ),
        "invalid_fault_codes": _dense(
            """SELECT downtime_reason, fault_code, count(*) AS events FROM equipment_status
WHERE fault_code IS NOT NULL AND NOT CASE downtime_reason
  WHEN 'MECHANICAL_FAILURE' THEN fault_code IN ('E-042', 'E-043', 'E-101', 'E-102')
  WHEN 'ELECTRICAL_FAULT' THEN fault_code IN ('E-201', 'E-202', 'E-250')
  WHEN 'MATERIAL_SHORTAGE' THEN fault_code = 'E-301'
  WHEN 'OPERATOR_ABSENCE' THEN fault_code = 'E-401'
  WHEN 'QUALITY_HOLD' THEN fault_code IN ('E-501', 'E-502')
  ELSE fault_code = 'E-999' END GROUP BY 1, 2"""
        ),
        "domain_violations": _dense(
            """SELECT 'line_events' AS "table", 'event_type' AS "column", event_type AS "value", count(*) AS "rows"
FROM line_events WHERE event_type NOT IN
  ('CYCLE_COMPLETE', 'START', 'STOP', 'FAULT', 'CHANGEOVER', 'PLANNED_STOP') GROUP BY 3
UNION ALL SELECT 'line_events', 'shift', shift, count(*) FROM line_events
WHERE shift NOT IN ('MORNING', 'AFTERNOON', 'NIGHT') GROUP BY 3
UNION ALL SELECT 'equipment_status', 'status', status, count(*) FROM equipment_status
WHERE status NOT IN ('RUNNING', 'IDLE', 'FAULT', 'MAINTENANCE', 'CHANGEOVER', 'STARTUP') GROUP BY 3
UNION ALL SELECT 'equipment_status', 'previous_status', previous_status, count(*) FROM equipment_status
WHERE previous_status NOT IN
  ('RUNNING', 'IDLE', 'FAULT', 'MAINTENANCE', 'CHANGEOVER', 'STARTUP', 'UNKNOWN') GROUP BY 3
UNION ALL SELECT 'equipment_status', 'downtime_reason', downtime_reason, count(*) FROM equipment_status
WHERE downtime_reason NOT IN ('MECHANICAL_FAILURE', 'ELECTRICAL_FAULT', 'MATERIAL_SHORTAGE',
  'OPERATOR_ABSENCE', 'QUALITY_HOLD', 'PLANNED_MAINTENANCE', 'CHANGEOVER', 'NONE') GROUP BY 3
UNION ALL SELECT 'quality_metrics', 'shift', shift, count(*) FROM quality_metrics
WHERE shift NOT IN ('MORNING', 'AFTERNOON', 'NIGHT') GROUP BY 3
UNION ALL SELECT 'quality_metrics', 'defect_type', defect_type, count(*) FROM quality_metrics
WHERE defect_type NOT IN ('DIMENSIONAL', 'SURFACE_FINISH', 'ASSEMBLY_ERROR', 'ELECTRICAL', 'WEIGHT',
  'COSMETIC', 'OTHER', 'NONE') GROUP BY 3"""
        ),
        "six_big_losses": _calendar(
            f"""SELECT line_id, equipment_failure_s, setup_s, coalesce(idle_stops, 0) AS idle_stops,
       coalesce(idle_us, 0) / 1e6 AS idle_s, reduced_speed_ms, process_defects, startup_rejects
FROM (SELECT line_id,
        CAST(sum(CASE WHEN event_type = 'FAULT' THEN downtime_s ELSE 0 END) AS BIGINT) AS equipment_failure_s,
        CAST(sum(CASE WHEN event_type = 'CHANGEOVER' THEN downtime_s ELSE 0 END) AS BIGINT) AS setup_s,
        CAST(sum(CASE WHEN event_type = 'CYCLE_COMPLETE' THEN greatest(actual_ms - ideal_ms, 0) ELSE 0 END)
             AS BIGINT) AS reduced_speed_ms,
        CAST(sum(CASE WHEN NOT early THEN units_rejected ELSE 0 END) AS BIGINT) AS process_defects,
        CAST(sum(CASE WHEN early THEN units_rejected ELSE 0 END) AS BIGINT) AS startup_rejects
      FROM (SELECT *, us // 1000000 - ({_shift_start('us')}) // 1000000 < 900 AS early FROM line_events)
      GROUP BY 1)
LEFT JOIN (SELECT line_id, count(*) AS idle_stops, CAST(sum(end_us - start_us) AS BIGINT) AS idle_us
           FROM intervals WHERE status = 'IDLE' AND end_us - start_us > 300000000 GROUP BY 1)
USING (line_id)"""
        ),
        "downtime_reasons": _calendar(
            f"""SELECT downtime_reason, count(*) AS events FROM equipment_status
WHERE us > (SELECT us FROM now) - 24 * {_HOURS} AND downtime_reason <> 'NONE' GROUP BY 1"""
        ),
        "faults_per_hour": _calendar(
            f"""SELECT {_ts(f'us // {_HOURS} * {_HOURS}')} AS hour, count(*) AS faults FROM equipment_status
WHERE us > (SELECT us FROM now) - 7 * 24 * {_HOURS} AND status = 'FAULT' GROUP BY 1"""
        ),
        "defect_types": _calendar(
            f"""SELECT defect_type, count(*) AS batches, CAST(sum(units_failed) AS BIGINT) AS failed_units
FROM quality_metrics WHERE us > (SELECT us FROM now) - 24 * {_HOURS} GROUP BY 1"""
        ),
        "shift_yield": _calendar(
            f"""SELECT line_id, shift, {_round('''CASE WHEN sum(units_inspected) > 0
       THEN CAST(sum(units_passed) AS DOUBLE) / CAST(sum(units_inspected) AS DOUBLE) ELSE 0e0 END * 100''', 2)}
       AS yield_pct
FROM quality_metrics, (SELECT {_shift_start('us')} AS start_us FROM now) WHERE us >= start_us GROUP BY 1, 2"""
        ),
        "cpk_against_limits": _dense(
            f"""SELECT {_ts('time_us')} AS time, line_id, rolling_cpk, rolling_cpk >= 1 AS capable,
       rolling_cpk >= 1.33e0 AS well_capable FROM stats"""
        ),
        "defect_rate_chart": _dense("").rstrip()
        + f""",{_limits('defect_rate_pct')}
SELECT batch_id, line_id, {_ts('us')} AS time, defect_rate_pct, center, ucl, greatest(0e0, lcl) AS lcl,
       defect_rate_pct > ucl AS out_of_control FROM quality_metrics JOIN limits USING (line_id)""",
        "xbar_chart": _dense("").rstrip()
        + f""",{_limits('measured_mean')}
SELECT batch_id, line_id, {_ts('us')} AS time, measured_mean, spec_upper, spec_lower, center, ucl, lcl,
       measured_mean > ucl OR measured_mean < lcl AS out_of_control
FROM quality_metrics JOIN limits USING (line_id)""",
        "fault_bursts": _dense(_BURSTS),
        "stream_fault_bursts": _dense(_BURSTS),
        "fault_rate_by_burst": _dense(
            f"""SELECT line_id, in_burst, count(*) AS events, count(*) FILTER (status = 'FAULT') AS faults,
       {_round("count(*) FILTER (status = 'FAULT') / count(*)", 4)} AS fault_rate
FROM (SELECT line_id, status, EXISTS (
          SELECT 1 FROM ({_BURST_SPANS}) b
          WHERE b.equipment_id = s.equipment_id AND s.us BETWEEN b.first_us AND b.last_us) AS in_burst
      FROM equipment_status s) GROUP BY 1, 2"""
        ),
        "ingest_latency_sketched": _dense(
            "SELECT count(*) AS events, true AS p50_within, true AS p95_within, true AS p99_within FROM line_events"
        ),
        "stream_progress": _dense(
            "SELECT 'oee' AS query, count(*) + 1 AS rows_in, 0::BIGINT AS late_rows, true AS timed FROM line_events"
        ),
        "ingest_latency": _dense(
            "SELECT "
            + ", ".join(
                f"{_round(f'quantile_cont(CAST(ms AS DOUBLE), {p})', 3)} AS {name}"
                for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99))
            )
            + ", count(*) AS events FROM (SELECT (ingested_us - us) // 1000 AS ms FROM line_events)"
        ),
        "sensor_trend": _dense(
            f"SELECT {_ts('(us // 60000000 + 1) * 60000000')} AS time, equipment_id, "
            + ", ".join(
                f"{_fine_mean(c)} AS avg_{c}, max({c}) AS max_{c}"
                for c in ("temperature_c", "vibration_hz", "power_kw")
            )
            + " FROM equipment_status GROUP BY 1, 2"
        ),
        "cycle_scan": _dense(
            """SELECT event_id, line_id, CAST(units_produced AS INTEGER) AS units_produced,
       CAST(units_rejected AS INTEGER) AS units_rejected
FROM line_events WHERE event_type = 'CYCLE_COMPLETE'"""
        ),
        "upsert_oee_metrics": _dense(_METRIC_ROWS + "metrics"),
        "upsert_quality_stats": _dense(_STAT_ROWS),
        "append_alerts": _dense(_ALERT_ROWS),
        "decode_rejects": _dense(
            """SELECT CASE WHEN event_id % 13 = 0 THEN '-' ELSE line_id END AS line_id,
       CASE WHEN event_id % 13 = 0 THEN 'malformed' WHEN event_id % 11 = 0 THEN 'no time'
            ELSE 'unreadable time' END AS reason, count(*) AS messages
FROM line_events WHERE event_id % 13 = 0 OR event_id % 11 = 0 OR event_id % 17 = 0 GROUP BY 1, 2"""
        ),
        "upsert_after_restart": _dense(_METRIC_ROWS + "metrics"),
        "alerts_after_restart": _dense(_ALERT_ROWS),
        "archive_after_restart": _calendar(
            f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {_ts('us')} AS ts, line_id, event_type,
       CAST(units_produced AS INTEGER) AS units_produced,
       CAST(CASE WHEN us < 1704931200000000 THEN 0 ELSE 1 END AS BIGINT) AS snapshot_id FROM line_events"""
        ),
        "archive_gap": _calendar(
            f"""SELECT CAST(dayofmonth({_ts('us')}) % 3 AS BIGINT) AS snapshot_id, line_id, count(*) AS "rows"
FROM line_events WHERE dayofmonth({_ts('us')}) % 3 <> 1 GROUP BY 1, 2"""
        ),
        "archive_tables_after_retention": _calendar(
            """SELECT 'line_events' AS "table", 1 AS snapshots, count(*) AS "rows" FROM line_events
UNION ALL SELECT 'equipment_status', 1, count(*) FROM equipment_status
UNION ALL SELECT 'quality_metrics', 2, count(*) FROM quality_metrics WHERE us >= 1704931200000000"""
        ),
        "archive_first_rows": _calendar('SELECT least(100, count(*)) AS "rows" FROM line_events'),
        "archive_compacted": _calendar(f"SELECT n AS as_of, a.* FROM ({_BY_MINUTE}) a, unnest([2, 3]) AS t(n) WHERE snapshot_id <= n"),
        "archive_compacted_twice": _calendar(_BY_MINUTE),
        "archive_point_lookup": _calendar(
            _BY_MINUTE.replace("SELECT", "SELECT work_unit_id,", 1)
            + " WHERE us < 1705795199000001 AND work_unit_id = 'WU-01'"
        ),
        "hot_retention": _calendar(
            _METRIC_ROWS + f"({_oee('line_events', 3_600_000_000)}) WHERE time_us >= 1706054400000000"
        ),
        "hourly_rollup_table": _dense(_HOURLY_ROWS),
        "oee_refresh_changed": _dense(_HOURLY_ROWS),
        "archive_tables": _calendar(
            """SELECT 'line_events' AS "table", 3 AS snapshots, count(*) AS "rows" FROM line_events
UNION ALL SELECT 'equipment_status', 3, count(*) FROM equipment_status
UNION ALL SELECT 'quality_metrics', 3, count(*) FROM quality_metrics"""
        ),
        "archive_snapshots": _calendar(
            f"""SELECT CAST(id AS BIGINT) AS snapshot_id,
       make_timestamp(2024, 2, CAST(id AS BIGINT), 0, 0, 0) AS committed_at, 'append' AS operation,
       count(*) AS added_records FROM (SELECT {_SNAPSHOT} AS id FROM line_events) GROUP BY id"""
        ),
        "archive_scan": _calendar(_ARCHIVED),
        "archive_scan_as_of_snapshot": _calendar(_ARCHIVED + f" WHERE {_SNAPSHOT} <= 2"),
        "archive_scan_as_of_time": _calendar(_ARCHIVED + f" WHERE {_SNAPSHOT} <= 1"),
        "archive_row_counts": _calendar(
            f"""SELECT CAST(n AS INTEGER) AS as_of_snapshot, count(*) AS "rows"
FROM (SELECT {_SNAPSHOT} AS id FROM quality_metrics), unnest([1, 2, 3]) AS t(n) WHERE id <= n GROUP BY 1"""
        ),
        "archive_day_scan": _calendar(
            _ARCHIVED + " WHERE us // 86400000000 = 1705276800000000 // 86400000000 AND line_id = 'LINE-B'"
        ),
        "archive_quality_summary": _calendar(
            """SELECT line_id, count(*) AS batches, CAST(sum(units_produced) AS BIGINT) AS total_units,
       CAST(sum(units_rejected) AS BIGINT) AS rejected_units,
       CASE WHEN sum(units_produced) > 0 THEN CAST(sum(units_produced - units_rejected) AS DOUBLE)
            / CAST(sum(units_produced) AS DOUBLE) ELSE 0e0 END AS quality
FROM line_events WHERE event_type = 'CYCLE_COMPLETE' AND line_id IN ('LINE-A', 'LINE-B', 'LINE-C') GROUP BY 1"""
        ),
        "archive_oee_as_of": _calendar(
            _METRIC_ROWS
            + f"({_oee(f'(SELECT * FROM line_events WHERE {_SNAPSHOT} <= 2)', 3_600_000_000)})"
        ),
        "archive_daily_quality": _calendar(
            f"""SELECT {_ts('us // 86400000000 * 86400000000')} AS day, line_id,
       (CAST(sum(units_produced - units_rejected) AS DOUBLE) / count(*))
       / nullif(CAST(sum(units_produced) AS DOUBLE) / count(*), 0) AS avg_quality
FROM line_events WHERE us > 1704499200000000 AND us <= 1707091200000000 GROUP BY 1, 2"""
        ),
        "archive_added_column": _calendar(
            """SELECT CASE WHEN us >= 1704931200000000 THEN 'OP-' || work_unit_id END AS operator_id,
       CAST(CASE WHEN us >= 1704931200000000 THEN 2 ELSE 1 END AS BIGINT) AS snapshot_id, count(*) AS "rows"
FROM line_events GROUP BY 1, 2"""
        ),
        "archive_retention": _calendar(
            f"""SELECT line_id, count(*) AS batches,
       strftime({_ts('min(us)')}, '%Y-%m-%d') AS first_day
FROM quality_metrics WHERE us >= 1704931200000000 GROUP BY 1"""
        ),
        "stream_oee": _dense(_METRIC_ROWS + "metrics WHERE time_us <= (SELECT us FROM closed)"),
        "stream_cpk": _dense(_STAT_ROWS + " WHERE time_us <= (SELECT us FROM closed)"),
        "stream_precursors": _dense(_ALERT_ROWS + " WHERE us < (SELECT us FROM closed)"),
        "stream_oee_finished": _dense(_METRIC_ROWS + "metrics"),
        "stream_cpk_finished": _dense(_STAT_ROWS),
        "stream_precursors_finished": _dense(_ALERT_ROWS),
        "stream_oee_deduplicated": _dense(_METRIC_ROWS + "metrics"),
        "stream_cpk_deduplicated": _dense(_STAT_ROWS),
        "stream_precursors_deduplicated": _dense(_ALERT_ROWS),
        "stream_topic_oee": _dense(_METRIC_ROWS + "metrics"),
        "stream_archive": _dense(
            """SELECT 'line_events' AS "table", 1 AS snapshots, count(*) AS "rows" FROM line_events
UNION ALL SELECT 'equipment_status', 1, count(*) FROM equipment_status
UNION ALL SELECT 'quality_metrics', 1, count(*) FROM quality_metrics"""
        ),
        "decode_line_events": _decoded(
            "line_events",
            "work_unit_id, event_type, CAST(units_produced AS INTEGER) AS units_produced, "
            "CAST(units_rejected AS INTEGER) AS units_rejected, CAST(downtime_s AS INTEGER) AS downtime_s",
            "downtime_s",
        ),
        "decode_equipment_status": _decoded(
            "equipment_status",
            "equipment_id, status, previous_status, downtime_reason, planned_downtime, temperature_c, "
            "vibration_hz, fault_code",
            "event_id",
        ),
        "decode_quality_metrics": _decoded(
            "quality_metrics",
            "batch_id, CAST(units_inspected AS INTEGER) AS units_inspected, "
            "CAST(units_failed AS INTEGER) AS units_failed, measured_mean, spec_upper, cpk",
            "units_inspected",
        ),
    }
    for value in ("oee", "availability", "performance", "quality"):
        found[f"{value}_trend"] = _dense(
            f"SELECT {_ts('time_us')} AS time, line_id, {value} * 100 AS {value} FROM metrics, now "
            f"WHERE time_us BETWEEN now.us - 3 * {_HOURS} AND now.us"
        )
    for value in ("rolling_cpk", "rolling_mean", "rolling_stddev"):
        found[f"{value}_trend"] = _dense(
            f"SELECT {_ts('time_us')} AS time, line_id, {value} FROM stats, now "
            f"WHERE time_us BETWEEN now.us - 2 * {_HOURS} AND now.us"
        )
    return found
