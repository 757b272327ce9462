"""Bursts: faults of one machine that follow each other closely.

A machine that has just faulted is likelier to fault again. Faults at most
``gap_s`` apart belong together; two or more of them are a burst, from the
first to the last. Sessions are merged per machine by Spark's session windows,
after only the faults have been kept, on tables and on watermarked streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas
from millwright.functions.numeric import count_if, round_metric, share

GAP_S = 120
#: readings are matched with bursts within time slots of this length
SLOT_S = 3600


def fault_sessions(status: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Per machine and session of faults: the first, the last, and how many.

    A session of a stream is emitted once the watermark has passed its last
    fault by the gap.
    """
    machine = F.coalesce("equipment_id", F.lit(schemas.UNKNOWN)).alias("equipment_id")
    wanted = F.col("status") == schemas.FAULT
    if status.isStreaming:
        # other readings move the watermark too: a term on the event time, never true, keeps the filter above it
        wanted = wanted | (F.col("ts") < F.lit("0001-01-01 00:00:00").cast("timestamp"))
    return (
        status.filter(wanted)
        .select(machine, "ts")
        .groupBy("equipment_id", F.session_window("ts", f"{gap_s} seconds").alias("span"))
        .agg(F.min("ts").alias("started"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("faults"))
        .drop("span")
    )


def fault_bursts(status: DataFrame, gap_s: int = GAP_S, least: int = 2) -> DataFrame:
    """Sessions of at least two faults."""
    return fault_sessions(status, gap_s).filter(F.col("faults") >= least)


def _slot(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / SLOT_S)


def in_bursts(status: DataFrame, bursts: DataFrame) -> DataFrame:
    """Readings with ``in_burst``: whether they fall between the first and the last fault of a burst.

    A burst stands under every time slot it touches, so that readings and
    bursts meet by machine and slot, and no machine's history in one task.
    """
    spans = bursts.select(
        F.col("equipment_id").alias("of"), "started", "last",
        F.explode(F.sequence(_slot(F.col("started")), _slot(F.col("last")))).alias("of_slot"),
    )
    rows = status.select(F.struct(*status.columns).alias("reading"))
    machine, ts = F.coalesce("reading.equipment_id", F.lit(schemas.UNKNOWN)), F.col("reading.ts")
    inside = (machine == F.col("of")) & (_slot(ts) == F.col("of_slot")) & ts.between(F.col("started"), F.col("last"))
    # bursts of a machine never overlap, so a reading meets one at most
    return rows.join(spans, inside, "left").select("reading.*", F.col("of").isNotNull().alias("in_burst"))


def fault_rate_by_burst(status: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Readings, faults and fault rate inside and outside bursts, per line."""
    return (
        in_bursts(status, fault_bursts(status, gap_s))
        .groupBy("line_id", "in_burst")
        .agg(F.count(F.lit(1)).alias("events"), count_if(F.col("status") == schemas.FAULT).alias("faults"))
        .withColumn("fault_rate", round_metric(share(F.col("faults"), F.col("events")), 4))
    )
