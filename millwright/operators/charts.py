"""Control limits for quality measurements.

The centre is an exact average. The spread is Spark's sample deviation, which
merges counts, means and squared distances, so it neither overflows nor
cancels; each line's limits need one hash aggregation, combined on the map
side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.clock import instant, shift_of, shift_start
from millwright.functions.numeric import fine_mean, round_metric, share
from millwright.operators.bounded import join_summary


def sigma_limits(batches: DataFrame, column: str) -> DataFrame:
    """Per line: mean and mean plus and minus three sample standard deviations."""
    x = F.col(column).cast("double")
    sums = batches.groupBy("line_id").agg(fine_mean(x).alias("center"), F.stddev_samp(x).alias("sigma"))
    return sums.select(
        "line_id",
        round_metric(F.col("center"), 4).alias("center"),
        round_metric(F.col("center") + 3 * F.col("sigma"), 4).alias("ucl"),
        round_metric(F.col("center") - 3 * F.col("sigma"), 4).alias("lcl"),
    )


def defect_rate_chart(batches: DataFrame) -> DataFrame:
    """Defect rate of every batch with its line's control limits."""
    limits = sigma_limits(batches, "defect_rate_pct")
    rate = F.col("defect_rate_pct").cast("double")
    return join_summary(
        batches.select("batch_id", "line_id", "ts", "defect_rate_pct"), limits, ["line_id"]
    ).select(
        "batch_id",
        "line_id",
        F.col("ts").alias("time"),
        rate.alias("defect_rate_pct"),
        "center",
        "ucl",
        F.greatest(F.lit(0.0), "lcl").alias("lcl"),
        (rate > F.col("ucl")).alias("out_of_control"),
    )


def xbar_chart(batches: DataFrame) -> DataFrame:
    """Measured mean of every batch with spec limits and its line's control limits."""
    limits = sigma_limits(batches, "measured_mean")
    mean = F.col("measured_mean").cast("double")
    return join_summary(
        batches.select("batch_id", "line_id", "ts", "measured_mean", "spec_upper", "spec_lower"),
        limits,
        ["line_id"],
    ).select(
        "batch_id",
        "line_id",
        F.col("ts").alias("time"),
        mean.alias("measured_mean"),
        F.col("spec_upper").cast("double").alias("spec_upper"),
        F.col("spec_lower").cast("double").alias("spec_lower"),
        "center",
        "ucl",
        "lcl",
        ((mean > F.col("ucl")) | (mean < F.col("lcl"))).alias("out_of_control"),
    )


def cpk_against_limits(stats: DataFrame) -> DataFrame:
    """Rolling Cpk with flags for the two customary limits."""
    return stats.select(
        "time",
        "line_id",
        "rolling_cpk",
        (F.col("rolling_cpk") >= 1.0).alias("capable"),
        (F.col("rolling_cpk") >= 1.33).alias("well_capable"),
    )


def shift_yield(batches: DataFrame, as_of) -> DataFrame:
    """Share of passed units per line in the shift that is running at ``as_of``."""
    as_of = instant(as_of)
    start = shift_start(as_of)
    return (
        batches.filter((F.col("ts") >= start) & (F.col("ts") <= as_of))
        .groupBy("line_id", shift_of(F.col("ts")).alias("shift"))
        .agg(F.sum("units_passed").alias("passed"), F.sum("units_inspected").alias("inspected"))
        .select(
            "line_id",
            "shift",
            round_metric(share(F.col("passed"), F.col("inspected")) * 100, 2).alias("yield_pct"),
        )
    )
