"""Reading loosely typed records into the declared contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coerce(x: Column, kind: T.DataType) -> Column:
    """Text to the contract type; a value that does not fit becomes null.

    Whole numbers go through double so that ``"7"``, ``7`` and ``7.9`` are all
    accepted, the latter cut to 7.
    """
    if isinstance(kind, T.IntegerType):
        return x.try_cast("double").try_cast("int")
    if isinstance(kind, T.StringType):
        return x
    return x.try_cast(kind.simpleString())


def parse_time(text: Column) -> Column:
    """ISO-8601 text, with or without offset, as an instant; null if unreadable."""
    return F.try_to_timestamp(text)


def iso_time(ts: Column) -> Column:
    """An instant as ISO-8601 text in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def all_text(contract: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in contract.fields])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
