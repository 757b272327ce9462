"""What continuous queries report of themselves, kept as a table.

``ProgressLog`` listens to the session's streaming queries and appends one row
per micro-batch: how long it took and how long its checkpoint took, how many
rows came in, how far the watermark lags behind the newest event, how many
rows were too late, and how many rows the state holds.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from millwright.sinks import folders

PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("checkpoint_ms", T.LongType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("lag_ms", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("state_rows", T.LongType()),
    ]
)
#: steps of a micro-batch that write its checkpoint
_CHECKPOINT = ("walCommit", "commitOffsets", "commitBatch")


def _moment(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text.replace("Z", "+00:00"))


def progress_row(progress) -> tuple:
    """One micro-batch's report in the table's layout."""
    spent, times = progress.durationMs, progress.eventTime
    newest, watermark = _moment(times.get("max")), _moment(times.get("watermark"))
    lag = None if newest is None or watermark is None else round((newest - watermark).total_seconds() * 1000)
    return (
        progress.name, str(progress.id), progress.batchId, _moment(progress.timestamp), spent.get("triggerExecution"),
        sum(spent.get(step, 0) for step in _CHECKPOINT), progress.numInputRows, lag,
        sum(s.numRowsDroppedByWatermark for s in progress.stateOperators), sum(s.numRowsTotal for s in progress.stateOperators),
    )


class ProgressLog(StreamingQueryListener):
    """Collects reports and appends them to the table at ``path``, at least every ``every`` micro-batches.

    The driver holds that many rows at most. ``flush`` writes the rest; a
    query's end does so too. A report names query, run and batch, so one that
    is written again after a restart can be told apart.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every, self.waiting = spark, path, every, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.waiting.append(progress_row(event.progress))
        if len(self.waiting) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.waiting = self.waiting, []
        if rows:
            name = f"{rows[0][3]:%Y%m%d}-{uuid.uuid4().hex}"
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.parquet(f"{self.path}/part={name}")

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *problem) -> None:
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch; the last report of a batch holds."""
    if not folders.has_data(spark, path):
        return spark.createDataFrame([], PROGRESS)
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(path)
    others = ["started", *[c for c in rows.columns if c not in ("run", "batch", "started")]]
    return rows.groupBy("run", "batch").agg(F.max(F.struct(*others)).alias("row")).select(
        *[F.col(f"row.{c}") if c in others else c for c in rows.columns]
    )


def progress_report(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows, late rows, and the median and 95th percentile of the times."""
    times = [
        F.percentile_approx(c, p, 1000).alias(f"{c[:-3]}_p{round(p * 100)}_ms")
        for c in ("batch_ms", "checkpoint_ms", "lag_ms")
        for p in (0.5, 0.95)
    ]
    return progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows_in").alias("rows_in"), F.sum("late_rows").alias("late_rows"),
        F.max("state_rows").alias("most_state_rows"), *times,
    )
