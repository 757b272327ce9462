"""Record layouts, value domains and fixed plant settings.

Everything here is data, not behaviour: the three event contracts, the four
result tables, and the constants the metrics are defined with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values ----------------------------------------------------------

PLANNED_TIME_S = 3600
OEE_WINDOW_S = 60
CPK_WINDOW_S = 600
CPK_SLIDE_S = 60
HIGH_TEMPERATURE_C = 85.0
HIGH_VIBRATION_HZ = 120.0
PRECURSOR_WINDOW_S = 30
WATERMARK_S = 45
ARCHIVE_INTERVAL_S = 60
HOT_RETENTION_DAYS = 7
ARCHIVE_RETENTION_DAYS = 90

CYCLE = "CYCLE_COMPLETE"
FAULT = "FAULT"
DOWNTIME_EVENT_TYPES = ("FAULT", "STOP", "PLANNED_STOP", "CHANGEOVER")
PLANNED_REASONS = ("PLANNED_MAINTENANCE", "CHANGEOVER")

ALERT_TYPE = "THERMAL_FAULT_PRECURSOR"
ALERT_SEVERITY = "HIGH"

DEFAULT_IDEAL_CYCLE_MS = 5000
DEFAULT_MTTR_MINUTES = 30
DEFAULT_FAULT_CODE = "E-999"
UNKNOWN = "UNKNOWN"

# line_id, ideal_cycle_time_ms, target_oee, spec_upper, spec_lower, spec_nominal
LINES = (
    ("LINE-A", 4800, 0.87, 10.05, 9.95, 10.00),
    ("LINE-B", 6200, 0.82, 25.10, 24.90, 25.00),
    ("LINE-C", 3500, 0.79, 5.025, 4.975, 5.00),
)

# downtime reason, expected minutes to repair
MTTR_MINUTES = (
    ("MECHANICAL_FAILURE", 45),
    ("ELECTRICAL_FAULT", 30),
    ("MATERIAL_SHORTAGE", 15),
    ("QUALITY_HOLD", 60),
    ("OPERATOR_ABSENCE", 20),
    ("PLANNED_MAINTENANCE", 30),
    ("CHANGEOVER", 25),
)

# downtime reason, fault code that belongs to it
FAULT_CODES = (
    ("MECHANICAL_FAILURE", "E-042"),
    ("MECHANICAL_FAILURE", "E-043"),
    ("MECHANICAL_FAILURE", "E-101"),
    ("MECHANICAL_FAILURE", "E-102"),
    ("ELECTRICAL_FAULT", "E-201"),
    ("ELECTRICAL_FAULT", "E-202"),
    ("ELECTRICAL_FAULT", "E-250"),
    ("MATERIAL_SHORTAGE", "E-301"),
    ("OPERATOR_ABSENCE", "E-401"),
    ("QUALITY_HOLD", "E-501"),
    ("QUALITY_HOLD", "E-502"),
)

SHIFTS = ("MORNING", "AFTERNOON", "NIGHT")
STATUSES = ("RUNNING", "IDLE", "FAULT", "MAINTENANCE", "CHANGEOVER", "STARTUP")
EVENT_TYPES = ("CYCLE_COMPLETE", "START", "STOP", "FAULT", "CHANGEOVER", "PLANNED_STOP")
DOWNTIME_REASONS = (
    "MECHANICAL_FAILURE",
    "ELECTRICAL_FAULT",
    "MATERIAL_SHORTAGE",
    "OPERATOR_ABSENCE",
    "QUALITY_HOLD",
    "PLANNED_MAINTENANCE",
    "CHANGEOVER",
    "NONE",
)
DEFECT_TYPES = (
    "DIMENSIONAL",
    "SURFACE_FINISH",
    "ASSEMBLY_ERROR",
    "ELECTRICAL",
    "WEIGHT",
    "COSMETIC",
    "OTHER",
    "NONE",
)

# gauge steps: lower bound (inclusive), colour; below the first bound the first colour holds
OEE_STEPS = ((0, "red"), (60, "yellow"), (85, "green"))
CPK_STEPS = ((0, "red"), (1.0, "yellow"), (1.33, "green"))
OPEN_ALERT_STEPS = ((0, "green"), (1, "orange"))
DAILY_ALERT_STEPS = ((0, "green"), (5, "yellow"), (20, "red"))

# --- event contracts -------------------------------------------------------

_STR, _INT, _FLOAT, _BOOL, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.FloatType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LINE_EVENTS = _struct(
    ("event_id", _STR),
    ("timestamp", _STR),
    ("schema_version", _STR),
    ("site_id", _STR),
    ("area_id", _STR),
    ("line_id", _STR),
    ("work_unit_id", _STR),
    ("shift", _STR),
    ("event_type", _STR),
    ("units_produced", _INT),
    ("units_rejected", _INT),
    ("ideal_cycle_time_ms", _INT),
    ("actual_cycle_time_ms", _INT),
    ("planned_production_time_s", _INT),
    ("downtime_s", _INT),
)

EQUIPMENT_STATUS = _struct(
    ("event_id", _STR),
    ("timestamp", _STR),
    ("schema_version", _STR),
    ("equipment_id", _STR),
    ("line_id", _STR),
    ("work_unit_id", _STR),
    ("status", _STR),
    ("previous_status", _STR),
    ("downtime_reason", _STR),
    ("planned_downtime", _BOOL),
    ("temperature_c", _FLOAT),
    ("vibration_hz", _FLOAT),
    ("power_kw", _FLOAT),
    ("fault_code", _STR),
)

QUALITY_METRICS = _struct(
    ("event_id", _STR),
    ("timestamp", _STR),
    ("schema_version", _STR),
    ("batch_id", _STR),
    ("line_id", _STR),
    ("work_unit_id", _STR),
    ("shift", _STR),
    ("units_inspected", _INT),
    ("units_passed", _INT),
    ("units_failed", _INT),
    ("defect_rate_pct", _FLOAT),
    ("defect_type", _STR),
    ("yield_pct", _FLOAT),
    ("spec_upper", _FLOAT),
    ("spec_lower", _FLOAT),
    ("measured_mean", _FLOAT),
    ("measured_stddev", _FLOAT),
    ("cpk", _FLOAT),
)

# topic name -> (table name, contract)
TOPICS = {
    "line-events": ("line_events", LINE_EVENTS),
    "equipment-status": ("equipment_status", EQUIPMENT_STATUS),
    "quality-metrics": ("quality_metrics", QUALITY_METRICS),
}
EVENT_TABLES = {table: contract for table, contract in TOPICS.values()}

# values a contract column takes when the record does not carry it
CONTRACT_DEFAULTS = {
    "line_events": {"schema_version": "1.0", "units_produced": 0, "units_rejected": 0, "downtime_s": 0},
    "equipment_status": {
        "schema_version": "1.0",
        "previous_status": "UNKNOWN",
        "downtime_reason": "NONE",
        "planned_downtime": False,
    },
    "quality_metrics": {"schema_version": "1.0", "defect_type": "NONE"},
}

# table -> column -> allowed values
DOMAINS = {
    "line_events": {"shift": SHIFTS, "event_type": EVENT_TYPES},
    "equipment_status": {
        "status": STATUSES,
        "previous_status": STATUSES + (UNKNOWN,),
        "downtime_reason": DOWNTIME_REASONS,
    },
    "quality_metrics": {"shift": SHIFTS, "defect_type": DEFECT_TYPES},
}

# --- result tables ---------------------------------------------------------

OEE_METRICS = _struct(
    ("time", _TS),
    ("line_id", _STR),
    ("availability", T.DecimalType(5, 4)),
    ("performance", T.DecimalType(5, 4)),
    ("quality", T.DecimalType(5, 4)),
    ("oee", T.DecimalType(5, 4)),
    ("total_units", _INT),
    ("good_units", _INT),
)

QUALITY_STATS = _struct(
    ("time", _TS),
    ("line_id", _STR),
    ("rolling_cpk", T.DecimalType(6, 3)),
    ("rolling_mean", T.DecimalType(10, 4)),
    ("rolling_stddev", T.DecimalType(10, 4)),
    ("window_batches", _INT),
)

ALERTS = _struct(
    ("id", T.LongType()),
    ("timestamp", _TS),
    ("equipment_id", _STR),
    ("line_id", _STR),
    ("alert_type", _STR),
    ("severity", _STR),
    ("temperature_c", T.DecimalType(6, 2)),
    ("fault_code", _STR),
    ("acknowledged", _BOOL),
    ("created_at", _TS),
)

OEE_HOURLY = _struct(
    ("bucket", _TS),
    ("line_id", _STR),
    ("avg_oee", T.DoubleType()),
    ("min_oee", T.DoubleType()),
    ("max_oee", T.DoubleType()),
    ("avg_availability", T.DoubleType()),
    ("avg_performance", T.DoubleType()),
    ("avg_quality", T.DoubleType()),
)


# --- dimensions as DataFrames ----------------------------------------------


def inline_table(spark: SparkSession, columns: str, rows: tuple[tuple, ...]) -> DataFrame:
    """A constant table whose exact size the optimizer knows.

    An inline ``VALUES`` relation carries real statistics, so Spark decides by
    itself whether it is below ``spark.sql.autoBroadcastJoinThreshold``; no
    broadcast hint is needed anywhere for the plant dimensions.
    """

    def literal(value):
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def line_settings(spark: SparkSession, lines: tuple[tuple, ...] = LINES) -> DataFrame:
    return inline_table(
        spark,
        "line_id, ideal_cycle_time_ms, target_oee, spec_upper, spec_lower, spec_nominal",
        lines,
    ).selectExpr(
        "line_id",
        "ideal_cycle_time_ms",
        "double(target_oee) AS target_oee",
        "double(spec_upper) AS spec_upper",
        "double(spec_lower) AS spec_lower",
        "double(spec_nominal) AS spec_nominal",
    )


def repair_times(spark: SparkSession) -> DataFrame:
    return inline_table(spark, "downtime_reason, expected_minutes", MTTR_MINUTES)


def fault_code_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, "downtime_reason, fault_code", FAULT_CODES)
