"""Rounding and order-independent averages.

Floating sums depend on the order partial results are merged in, so two runs
of one distributed query may differ in the last bit. Sums are therefore taken
of whole numbers, which stay in hash aggregation and need one division at the
end: of eight bytes where a stored figure has a fixed number of decimals, and
of decimals in steps of 10**-12 for measurements, whose precision is kept up
to 16 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_metric(x: Column, places: int) -> Column:
    scale = F.lit(10.0**places)
    return F.floor(x * scale + F.lit(0.5)) / scale


def round_text(x: str, places: int) -> str:
    """``round_metric`` as SQL text."""
    scale = f"{10**places}D"
    return f"floor(({x}) * {scale} + 0.5D) / {scale}"


def text_literal(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def scaled(x: Column, places: int) -> Column:
    """``x`` as a whole number of ``10**-places`` steps.

    ``rint`` stays in primitive arithmetic; ``round`` builds a decimal per row.
    """
    return F.rint(x.cast("double") * F.lit(10.0**places)).cast("bigint")


def mean_of_scaled(total: Column, count: Column, places: int) -> Column:
    return total.cast("double") / (count * F.lit(10.0**places))


def exact_mean(x: Column, places: int) -> Column:
    """Aggregate: average of a value with ``places`` decimals; nulls are skipped."""
    return mean_of_scaled(F.sum(scaled(x, places)), F.count(x), places)


def fine(x: Column) -> Column:
    """A measurement as a whole number of 10**-12 steps, wide enough for sums over any number of rows."""
    return F.rint(x.cast("double") * F.lit(1e12)).cast("decimal(26,0)")


def mean_of_fine(total: Column, count: Column) -> Column:
    return total.cast("double") / (count * F.lit(1e12))


def fine_mean(x: Column) -> Column:
    """Aggregate: average of a measurement; nulls are skipped."""
    return mean_of_fine(F.sum(fine(x)), F.count(x))


def count_if(condition: Column) -> Column:
    """Aggregate: rows where the condition holds."""
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, x: Column) -> Column:
    """Aggregate: sum over the rows where the condition holds, 0 when there are none."""
    return F.sum(F.when(condition, F.coalesce(x, F.lit(0))).otherwise(F.lit(0)))


def share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """``part / whole``; ``empty`` when the whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty).cast("double"))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def band(x: Column, steps: tuple[tuple[float, str], ...]) -> Column:
    """Gauge colour of a value; each step's lower bound is inclusive."""
    ordered = sorted(steps)
    colour = F.lit(ordered[0][1])
    for bound, name in ordered[1:]:
        colour = F.when(x >= bound, F.lit(name)).otherwise(colour)
    return F.when(x.isNotNull(), colour)


def oee_class(percent: Column) -> Column:
    return (
        F.when(percent > 85, "World Class")
        .when(percent >= 60, "Typical")
        .when(percent >= 40, "Low")
        .when(percent.isNotNull(), "Poor")
    )
