from __future__ import annotations

import statistics

import pytest
from support import at, batch, batch_frame

from millwright.operators.capability import rolling_cpk


def windows(spark, rows, **options):
    return rolling_cpk(batch_frame(spark, rows), **options).orderBy("time").collect()


def full(spark, rows):
    """The window that ends a minute after the last batch and holds them all."""
    found = [r for r in windows(spark, rows) if r.window_batches == len(rows)]
    return found[-1] if found else None


def spread(count, **changes):
    return [batch(i * 20, **changes) for i in range(count)]


def readings(*pairs):
    return [batch(15 * i, measured_mean=m, measured_stddev=s) for i, (m, s) in enumerate(pairs)]


# (mean, deviation) of batches between the limits 9.95 and 10.05; then index, mean and deviation by hand
CASES = {
    "above the middle": ([(10.00, 0.01), (10.02, 0.02)], (0.889, 10.01, 0.015)),
    "below the middle": ([(9.96, 0.005), (9.96, 0.005), (9.96, 0.005)], (0.667, 9.96, 0.005)),
    "outside the limits": ([(10.07, 0.01), (10.09, 0.01)], (-1.0, 10.08, 0.01)),
    "in the middle": ([(10.0, 0.004), (9.99, 0.006), (10.01, 0.005)], (3.333, 10.0, 0.005)),
    "finer than four decimals": ([(10.0000004, 0.00004), (10.0000002, 0.00004)], (416.664, 10.0, 0.0)),
}


@pytest.mark.parametrize("pairs, want", CASES.values(), ids=list(CASES))
def test_index(spark, pairs, want):
    row = full(spark, readings(*pairs))
    assert (row.rolling_cpk, row.rolling_mean, row.rolling_stddev) == want
    assert row.window_batches == len(pairs)


def test_windows_without_a_figure(spark):
    assert windows(spark, readings((10.0, 0.01))) == []
    assert windows(spark, readings((10.0, 0.0), (10.01, 0.0))) == []


def test_the_last_batch_is_found_among_ids_of_64_bits(spark):
    rows = [batch(0, event_id=str(n), spec_upper=u) for n, u in ((1 << 40, 10.10), ((1 << 40) + (1 << 37), 10.07), (5, 10.20))]
    frame = batch_frame(spark, rows)
    numbered = frame.withColumn("event_id", frame.event_id.cast("bigint"))
    (row, *_) = rolling_cpk(numbered).orderBy("time").collect()
    assert row.rolling_cpk == 1.333
    # as text the last id is the 5, and the lower limit is the nearer one
    (text, *_) = rolling_cpk(frame).orderBy("time").collect()
    assert text.rolling_cpk == 1.867


def test_zero_spread_is_counted_but_not_averaged(spark):
    row = full(spark, [batch(0, measured_stddev=0.0), batch(30, measured_stddev=0.02)])
    assert (row.window_batches, row.rolling_stddev) == (2, 0.02)


def test_limits_come_from_the_last_batch(spark):
    rows = [
        batch(0, spec_upper=99.0, spec_lower=0.0),
        batch(90, event_id="b", spec_upper=10.05, spec_lower=9.95),
        batch(90, event_id="a", spec_upper=50.0, spec_lower=0.0),
    ]
    integer_ids = batch_frame(spark, rows).replace({"b": "9", "a": "3", "batch-00000.000": "1"})
    found = rolling_cpk(integer_ids.withColumn("event_id", integer_ids.event_id.cast("bigint")))
    row = next(r for r in found.collect() if r.window_batches == 3)
    assert row.rolling_cpk == pytest.approx((10.05 - 10.02) / (3 * 0.0125), abs=1e-3)


def test_limits_of_equal_batches_belong_together(spark):
    rows = [
        batch(5, event_id="x", spec_upper=10.05, spec_lower=9.95),
        batch(5, event_id="y", spec_upper=20.0, spec_lower=1.0),
    ]
    row = full(spark, rows)
    narrow = round((10.05 - 10.02) / (3 * 0.0125), 3)
    wide = round((10.02 - 1.0) / (3 * 0.0125), 3)
    assert row.rolling_cpk in (pytest.approx(narrow, abs=1e-3), pytest.approx(wide, abs=1e-3))


def test_crossed_limits_give_zero(spark):
    assert full(spark, spread(2, spec_upper=9.0, spec_lower=10.0)).rolling_cpk == 0.0


def test_each_batch_is_in_ten_windows(spark):
    rows = [batch(0), batch(1)]
    found = windows(spark, rows)
    assert [int((r.time.timestamp() - at(0).timestamp()) // 60) for r in found] == list(range(1, 11))


def test_wide_slides_are_cut_into_short_panes(spark):
    found = windows(spark, spread(40), window_s=1200, slide_s=600)
    assert sum(r.window_batches for r in found) == 80


def test_against_plain_arithmetic(spark):
    rows = [
        batch(i * 37, measured_mean=10 + (i * 7 % 11) / 1000, measured_stddev=(i % 5) / 1000)
        for i in range(60)
    ]
    for row in windows(spark, rows):
        end = row.time.timestamp()
        inside = [r for r in rows if end - 600 <= r["ts"].timestamp() < end]
        sigmas = [r["measured_stddev"] for r in inside if r["measured_stddev"] > 0]
        mean, sigma = statistics.mean(r["measured_mean"] for r in inside), statistics.mean(sigmas)
        want = min((10.05 - mean) / (3 * sigma), (mean - 9.95) / (3 * sigma))
        assert row.window_batches == len(inside)
        assert row.rolling_cpk == pytest.approx(want, abs=6e-4)
        assert row.rolling_mean == pytest.approx(mean, abs=6e-5)
