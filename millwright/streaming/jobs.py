"""The four continuous jobs: effectiveness, capability, alerts and archive.

Each job is the batch operator on a watermarked stream plus an idempotent
sink, so a restarted query repeats its last micro-batch without effect. A new
checkpoint is a new run: its batches are added to those of earlier runs. A run
with ``once=True`` processes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwright import schemas
from millwright.operators.bursts import fault_bursts
from millwright.operators.capability import rolling_cpk
from millwright.operators.oee import oee_by_window
from millwright.sinks import archive, folders, tables
from millwright.sources.feeds import BEAT, file_feed, once_each
from millwright.streaming.ordered_state import interval_stream, precursor_stream

DELAY = f"{schemas.WATERMARK_S} seconds"


def with_heartbeat(events: DataFrame, folder: str | None) -> DataFrame:
    """Events together with the heartbeats of a folder, which carry nothing but a time.

    A feed that has ended or gone quiet moves no watermark, so its last windows
    would stay open. ``beat`` closes them.
    """
    if folder is None:
        return events
    folders.make(events.sparkSession, folder)
    beats = file_feed(events.sparkSession, folder, "ts timestamp").withColumn(BEAT, F.lit(True))
    return events.withColumn(BEAT, F.lit(False)).unionByName(beats, allowMissingColumns=True)


def beat(spark: SparkSession, folder: str, at: datetime) -> None:
    """Says that the time is ``at``: windows that end more than the delay before it will be closed."""
    spark.createDataFrame([(at,)], "ts timestamp").coalesce(1).write.mode("append").parquet(folder)


def finish(
    start: Callable[[], StreamingQuery], spark: SparkSession, folder: str, at: datetime, *, one_batch_runs: bool = False
) -> None:
    """Runs a job over a finished feed to its end, last windows included.

    ``start`` starts the job with ``once`` and the heartbeat folder; it is
    called on one checkpoint before and after the heartbeat. With a source
    that gives a run one micro-batch only (``message_log`` does), the windows
    that the heartbeat closes come with a second one.
    """
    start().awaitTermination()
    for _ in range(2 if one_batch_runs else 1):
        beat(spark, folder, at)
        start().awaitTermination()


def _watermarked(events: DataFrame, delay: str, distinct: bool) -> DataFrame:
    rows = events.withWatermark("ts", delay)
    if distinct:
        rows = once_each(rows)
    if BEAT not in events.columns:
        return rows
    # the term on the event time, never true, keeps the filter above the watermark
    never = F.col("ts") < F.lit("0001-01-01 00:00:00").cast("timestamp")
    return rows.filter(~F.col(BEAT) | never).drop(BEAT)


def oee_stream(events: DataFrame, *, delay: str = DELAY, distinct: bool = False, **options) -> DataFrame:
    """Windows of a line event stream, each emitted once, when the watermark passes its end."""
    return oee_by_window(_watermarked(events, delay, distinct), **options)


def cpk_stream(batches: DataFrame, *, delay: str = DELAY, distinct: bool = False, **options) -> DataFrame:
    """Sliding windows of a quality stream, panes first, in append mode."""
    return rolling_cpk(_watermarked(batches, delay, distinct), **options)


def run(
    rows: DataFrame,
    sink: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    *,
    name: str | None = None,
    every_s: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Starts a query that hands each micro-batch to an idempotent sink, with the run and its number.

    The run is the query's id, which its checkpoint keeps over restarts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Streaming turns adaptive execution off for its own, stateful plans. What
        # the sink runs are ordinary queries, which may adapt to the batch's size.
        conf = batch.sparkSession.conf
        before = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            sink(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", before)

    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every_s is not None:
        writer = writer.trigger(processingTime=f"{every_s} seconds")
    return writer.foreachBatch(write).start()


def run_oee(
    events: DataFrame, table: str, checkpoint: str, *, heartbeat: str | None = None, distinct: bool = False, **options
) -> StreamingQuery:
    return run(
        oee_stream(with_heartbeat(events, heartbeat), distinct=distinct),
        lambda batch, run, n: tables.upsert_oee_metrics(table, batch, batch=n),
        checkpoint,
        **options,
    )


def run_cpk(
    batches: DataFrame, table: str, checkpoint: str, *, heartbeat: str | None = None, distinct: bool = False, **options
) -> StreamingQuery:
    return run(
        cpk_stream(with_heartbeat(batches, heartbeat), distinct=distinct),
        lambda batch, run, n: tables.upsert_quality_stats(table, batch, batch=n),
        checkpoint,
        **options,
    )


def run_alerts(
    status: DataFrame, table: str, checkpoint: str, *, heartbeat: str | None = None, distinct: bool = False, **options
) -> StreamingQuery:
    return run(
        precursor_stream(with_heartbeat(status, heartbeat), distinct=distinct),
        lambda batch, run, n: tables.append_alerts(table, batch, batch=n, run=run),
        checkpoint,
        **options,
    )


def _append(path: str) -> Callable[[DataFrame, str, int], None]:
    """A sink that adds each batch to a table; a repeated batch replaces its own earlier rows only."""

    def write(batch: DataFrame, run: str, n: int) -> None:
        named = batch.withColumns({"run": F.lit(run), "batch": F.lit(n).cast("bigint")})
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run", "batch").parquet(path)

    return write


def run_intervals(
    status: DataFrame, path: str, checkpoint: str, *, heartbeat: str | None = None, distinct: bool = False, **options
) -> StreamingQuery:
    """Finished status intervals."""
    return run(interval_stream(with_heartbeat(status, heartbeat), distinct=distinct), _append(path), checkpoint, **options)


def run_bursts(
    status: DataFrame, path: str, checkpoint: str, *, heartbeat: str | None = None, distinct: bool = False, **options
) -> StreamingQuery:
    """Bursts of faults, each once no further fault can join it."""
    rows = _watermarked(with_heartbeat(status, heartbeat), DELAY, distinct)
    return run(fault_bursts(rows), _append(path), checkpoint, **options)


def run_archive(
    events: DataFrame,
    root: str,
    table: str,
    checkpoint: str,
    *,
    every_s: int = schemas.ARCHIVE_INTERVAL_S,
    **options,
) -> StreamingQuery:
    """Archives one topic; each micro-batch with rows becomes one snapshot."""

    return run(
        events,
        lambda batch, run, n: archive.append_snapshot(root, table, batch, n, run=run),
        checkpoint,
        every_s=every_s,
        **options,
    )
