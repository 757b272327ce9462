"""Rolling process capability.

A ten-minute window that slides by a minute would copy each row ten times.
Rows are first reduced to one row per line and minute; only those panes are
copied, so the copied data no longer grows with the event rate.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.capability import cpk
from millwright.functions.numeric import fine, mean_of_fine, round_metric


def _recency(event_id: T.DataType, pane_start: Column) -> Column:
    """A key that orders the rows of one pane by (ts, event_id).

    For whole-number ids it is one decimal, the offset inside the pane before
    all 64 bits of the id; its fixed width keeps ``max_by`` in hash
    aggregation. Text ids are compared as they are.
    """
    offset = F.unix_micros("ts") - F.unix_micros(pane_start)
    if not isinstance(event_id, T.IntegralType):
        return F.struct(offset, F.coalesce(F.col("event_id").cast("string"), F.lit("")))
    number = F.coalesce(F.col("event_id").cast("decimal(20,0)"), F.lit(0))
    return (offset.cast("decimal(10,0)") * F.lit(Decimal(1 << 64)) + number).cast("decimal(38,0)")


def capability_panes(batches: DataFrame, pane_s: int) -> DataFrame:
    """Additive parts of the capability of one line over one pane."""
    sigma = F.col("measured_stddev")
    keyed = batches.select(
        F.coalesce("line_id", F.lit(schemas.UNKNOWN)).alias("line_id"),
        "ts",
        F.window("ts", f"{pane_s} seconds").alias("pane"),
        F.coalesce(fine(F.col("measured_mean")), F.lit(0)).alias("mean_steps"),
        F.when(sigma > 0, fine(sigma)).alias("sigma_steps"),
        F.coalesce(F.col("spec_upper").cast("double"), F.lit(0.0)).alias("spec_upper"),
        F.coalesce(F.col("spec_lower").cast("double"), F.lit(0.0)).alias("spec_lower"),
        "event_id",
    )
    recency = _recency(batches.schema["event_id"].dataType, F.col("pane.start"))
    return keyed.groupBy("line_id", "pane").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("mean_steps").alias("mean_sum"),
        F.count("sigma_steps").alias("sigma_n"),
        F.sum("sigma_steps").alias("sigma_sum"),
        F.max_by("spec_upper", recency).alias("spec_upper"),
        F.max_by("spec_lower", recency).alias("spec_lower"),
    )


def rolling_cpk(
    batches: DataFrame,
    *,
    window_s: int = schemas.CPK_WINDOW_S,
    slide_s: int = schemas.CPK_SLIDE_S,
) -> DataFrame:
    """One row per line and sliding window; ``time`` is the window end.

    The limits are those of the window's last batch. Windows with fewer than two
    batches, or without any positive spread, give no row. Runs unchanged on a
    watermarked stream.
    """
    pane_s = math.gcd(window_s, slide_s)
    panes = capability_panes(batches, pane_s)
    rolled = panes.groupBy(
        F.window(F.window_time("pane"), f"{window_s} seconds", f"{slide_s} seconds").alias("span"),
        "line_id",
    ).agg(
        F.sum("n").alias("window_batches"),
        F.sum("mean_sum").alias("mean_sum"),
        F.sum("sigma_n").alias("sigma_n"),
        F.sum("sigma_sum").alias("sigma_sum"),
        F.max_by("spec_upper", F.col("pane.start")).alias("upper"),
        F.max_by("spec_lower", F.col("pane.start")).alias("lower"),
    )
    rated = rolled.filter((F.col("window_batches") >= 2) & (F.col("sigma_n") > 0)).select(
        F.col("span.end").alias("time"),
        "line_id",
        mean_of_fine(F.col("mean_sum"), F.col("window_batches")).alias("m"),
        mean_of_fine(F.col("sigma_sum"), F.col("sigma_n")).alias("s"),
        "upper",
        "lower",
        "window_batches",
    )
    index = F.when(
        (F.col("s") > 0) & (F.col("upper") > F.col("lower")),
        cpk(F.col("m"), F.col("s"), F.col("upper"), F.col("lower")),
    ).otherwise(0.0)
    return rated.select(
        "time",
        "line_id",
        round_metric(index, 3).alias("rolling_cpk"),
        round_metric(F.col("m"), 4).alias("rolling_mean"),
        round_metric(F.col("s"), 4).alias("rolling_stddev"),
        "window_batches",
    )
