"""Registered queries against their SQL on the smallest data set.

``python tools/compare.py <folder>`` runs all of them on any data set.
"""

from __future__ import annotations

import os
import sys

import pytest
from support import DATA

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare as checker  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from millwright.plans import register  # noqa: E402

NAMES = list(register.registered())


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(DATA):
        pytest.skip("test data not present")
    return checker.connect(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, connection, name):
    good, note = checker.compare(spark, connection, DATA, name)
    assert good, note


def test_entry(spark):
    if not os.path.isdir(DATA):
        pytest.skip("test data not present")
    df = entry.entry(spark)
    assert df.columns[:2] == ["time", "line_id"] and df.count() > 0
