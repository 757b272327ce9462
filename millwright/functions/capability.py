"""Process capability arithmetic shared by single batches and rolling windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cpk(mean: Column, stddev: Column, upper: Column, lower: Column) -> Column:
    """Distance of the mean to the nearer limit in units of three sigma."""
    three_sigma = F.lit(3.0) * stddev
    return F.least((upper - mean) / three_sigma, (mean - lower) / three_sigma)
