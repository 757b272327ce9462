"""Column functions over whole texts, and stored intermediate tables."""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.session import scratch_path

#: texts handed to Python at a time, in bytes; one longer text comes alone
BATCH_BYTES = 4 << 20
#: bits of the filters sent to tasks; a full filter lets everything pass and only costs time
FILTER_BITS = 1 << 25
_BITMAP = 1 << 15

Work = Callable[[list[bytes]], dict[str, Sequence]]


def bounded_batches(spark: SparkSession) -> None:
    """Let the bytes of a batch, not only its rows, bound the memory of a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def utf8(column: str | Column) -> Column:
    """A text as bytes; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def text_struct(prepare: Callable[[], Work], layout: str) -> Callable[[str | Column], Column]:
    """A column function that turns each text into one struct of ``layout``.

    ``prepare`` runs once per task and returns the function that maps a batch
    of texts to the fields. It counts as non-deterministic only so that the
    optimizer never evaluates it twice for one row.
    """

    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = prepare()
        for batch in texts:
            yield pd.DataFrame(work(batch.tolist()))

    batches.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    apply = F.pandas_udf(batches, layout).asNondeterministic()
    return lambda column: apply(utf8(column))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with a number if a column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    names = (name if n == 0 else f"{name}_{n}" for n in range(len(taken) + 1))
    return next(found for found in names if found.lower() not in taken)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy cuts the lineage and outlives any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_filter(rows: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size that holds a long column, put together in Spark as bitmaps."""
    slot = F.pmod(F.col(column), F.lit(FILTER_BITS)).alias("slot")
    parts = (
        rows.select(slot)
        .groupBy(F.floor(F.col("slot") / _BITMAP).alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod("slot", F.lit(_BITMAP))).alias("bits"))
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    # at most FILTER_BITS / 2^15 rows of 4 KB
    for row in parts.toLocalIterator():
        bits[row["part"] * _BITMAP // 8 :][: _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which longs the filter may hold; those it holds are always among them."""
    slot = values.astype(np.int64) % FILTER_BITS
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
