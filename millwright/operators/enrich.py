"""Calendar tagging and consistency reports on the event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.capability import cpk
from millwright.functions.clock import in_changeover, in_cold_start, shift_of, shift_start
from millwright.functions.numeric import count_if, round_metric, share, sum_if
from millwright.operators.oee import production_totals, rate_totals, with_ideal_cycle
from millwright.operators.precursors import reading


def with_shift(events: DataFrame) -> DataFrame:
    """Adds the shift name and the start of the shift instance."""
    return events.withColumn("shift", shift_of(F.col("ts"))).withColumn(
        "shift_start", shift_start(F.col("ts"))
    )


def oee_by_shift(
    events: DataFrame, planned_time_s: int = 27_000, lines: DataFrame | None = None
) -> DataFrame:
    """Effectiveness per line and shift instance; a shift plans 450 working minutes."""
    totals = with_shift(events).groupBy("line_id", "shift", "shift_start").agg(*production_totals())
    return rate_totals(
        with_ideal_cycle(totals, lines), ["line_id", "shift", "shift_start"], planned_time_s
    )


def last_shifts(by_shift: DataFrame, count: int = 3) -> DataFrame:
    """Rows of the newest shift instances that occur in the data."""
    newest = (
        by_shift.select("shift_start")
        .distinct()
        .orderBy(F.col("shift_start").desc())
        .limit(count)
    )
    return by_shift.join(F.broadcast(newest), "shift_start", "left_semi")


def with_batch_quality(batches: DataFrame) -> DataFrame:
    """Adds defect rate, yield and Cpk recomputed from the counts and measurements."""
    inspected = F.col("units_inspected")
    sigma = F.col("measured_stddev").cast("double")

    def percent(part):
        return round_metric(share(part, inspected) * 100, 2)

    index = F.when(
        sigma > 0,
        cpk(
            F.col("measured_mean").cast("double"),
            sigma,
            F.col("spec_upper").cast("double"),
            F.col("spec_lower").cast("double"),
        ),
    ).otherwise(0.0)
    return batches.withColumns(
        {
            "computed_defect_rate_pct": percent(F.col("units_failed")),
            "computed_yield_pct": percent(inspected - F.col("units_failed")),
            "computed_cpk": round_metric(index, 3),
        }
    )


def quality_mismatches(batches: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Stored figures that differ from the recomputed ones, one row per figure.

    The figures are listed and unpacked instead of filtered: a filter would be
    moved below the computation and repeat it.
    """
    differing = []
    for figure in ("defect_rate_pct", "yield_pct", "cpk"):
        stored, computed = F.col(figure).cast("double"), F.col(f"computed_{figure}")
        entry = F.struct(
            F.lit(figure).alias("figure"), stored.alias("stored"), computed.alias("computed")
        )
        differing.append(F.when(F.abs(stored - computed) > tolerance, entry))
    return with_batch_quality(batches).select(
        "batch_id", "line_id", F.inline(F.array_compact(F.array(*differing)))
    )


def planned_downtime_split(status: DataFrame) -> DataFrame:
    """Downtime events per line, planned against unplanned, and wrongly flagged ones."""
    down = F.col("downtime_reason") != "NONE"
    planned = F.col("downtime_reason").isin(*schemas.PLANNED_REASONS)
    return status.groupBy("line_id").agg(
        count_if(down & planned).alias("planned"),
        count_if(down & ~planned).alias("unplanned"),
        count_if(planned != F.col("planned_downtime")).alias("flag_mismatches"),
    )


def downtime_seconds_split(events: DataFrame) -> DataFrame:
    """Seconds lost per line to planned stops and changeovers against faults and stops."""
    kind = F.col("event_type")
    return events.groupBy("line_id").agg(
        sum_if(kind.isin("PLANNED_STOP", "CHANGEOVER"), F.col("downtime_s")).alias("planned_s"),
        sum_if(kind.isin("FAULT", "STOP"), F.col("downtime_s")).alias("unplanned_s"),
    )


def fault_rate_by_context(status: DataFrame) -> DataFrame:
    """Share of fault events by calendar and sensor context."""
    context = {
        "cold_start": in_cold_start(F.col("ts")),
        "changeover": in_changeover(F.col("ts")),
        "hot": reading("temperature_c") > schemas.HIGH_TEMPERATURE_C,
        "vibrating": reading("vibration_hz") > schemas.HIGH_VIBRATION_HZ,
    }
    return (
        status.withColumns(context)
        .groupBy(*context)
        .agg(
            F.count(F.lit(1)).alias("events"),
            count_if(F.col("status") == schemas.FAULT).alias("faults"),
        )
        .withColumn("fault_rate", round_metric(share(F.col("faults"), F.col("events")), 4))
    )


def with_expected_repair(frame: DataFrame) -> DataFrame:
    """Adds the expected minutes to repair for the row's downtime reason."""
    return frame.join(schemas.repair_times(frame.sparkSession), "downtime_reason", "left").withColumn(
        "expected_minutes",
        F.coalesce("expected_minutes", F.lit(schemas.DEFAULT_MTTR_MINUTES)),
    )


def repair_against_expected(intervals: DataFrame) -> DataFrame:
    """Actual against expected repair time per downtime reason.

    ``intervals`` must carry the ``downtime_reason`` of the event that opened each.
    """
    spent = F.unix_micros("ended") - F.unix_micros("started")
    actual = (
        intervals.filter((F.col("status") == schemas.FAULT) & F.col("ended").isNotNull())
        .groupBy("downtime_reason")
        .agg(F.count(F.lit(1)).alias("repairs"), F.sum(spent).alias("us"))
    )
    return with_expected_repair(actual).select(
        "downtime_reason",
        "repairs",
        round_metric(F.col("us").cast("double") / F.col("repairs") / F.lit(60e6), 2).alias(
            "actual_minutes"
        ),
        "expected_minutes",
    )


def invalid_fault_codes(status: DataFrame) -> DataFrame:
    """Fault codes that do not belong to the reason they were reported with.

    Reported pairs are counted before the lookup, so the lookup sees one row
    per distinct pair.
    """
    reported = (
        status.filter(F.col("fault_code").isNotNull())
        .groupBy("downtime_reason", "fault_code")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    codes = schemas.fault_code_table(status.sparkSession)
    listed = codes.select("downtime_reason", "fault_code").distinct().withColumn("listed", F.lit(True))
    covered = codes.select("downtime_reason").distinct().withColumn("covered", F.lit(True))
    # the default code goes with every reason that has no codes of its own
    fallback = (
        (F.col("fault_code") == schemas.DEFAULT_FAULT_CODE)
        & F.col("downtime_reason").isNotNull()
        & F.col("covered").isNull()
    )
    return (
        reported.join(listed, ["downtime_reason", "fault_code"], "left")
        .join(covered, "downtime_reason", "left")
        .filter(F.col("listed").isNull() & ~fallback)
        .select("downtime_reason", "fault_code", "events")
    )


def domain_violations(events: DataFrame, table: str) -> DataFrame:
    """Values outside the contract's enumerations, with their number of rows.

    One pass over the table: each row contributes only its offending columns.
    """
    offending = [
        F.when(
            ~F.coalesce(F.col(column), F.lit("")).isin(*allowed),
            F.struct(F.lit(column).alias("column"), F.col(column).alias("value")),
        )
        for column, allowed in schemas.DOMAINS[table].items()
    ]
    return (
        events.select(F.explode(F.array_compact(F.array(*offending))).alias("bad"))
        .groupBy(F.lit(table).alias("table"), "bad.column", "bad.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
