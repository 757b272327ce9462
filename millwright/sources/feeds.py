"""Opening an event feed and decoding its records.

A feed is either a topic of JSON messages or a folder of files. Batch and
streaming reads return the same columns, so every operator runs on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.coerce import all_text, any_of, coerce, iso_time, parse_time

_BROKEN = "_broken_record"
# marks the rows that only move the watermark
BEAT = "_heartbeat"


def topic_feed(
    spark: SparkSession,
    topic: str,
    servers: str,
    *,
    streaming: bool = True,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Messages of a topic as one ``payload`` text column.

    Progress is kept in the query checkpoint rather than in a consumer group.
    Needs the Kafka connector package on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    offsets = {"startingOffsets": starting if streaming else "earliest"}
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**offsets, **options)
        .load()
        .select(F.col("value").cast("string").alias("payload"))
    )


def file_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    kind: str = "parquet",
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """A folder of files; as a stream, each new file is one arrival."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(kind).schema(schema).options(**options).load(path)


def text_feed(spark: SparkSession, path: str, *, streaming: bool = True, **options: str) -> DataFrame:
    """JSON lines as one ``payload`` text column."""
    return file_feed(spark, path, "payload string", kind="text", streaming=streaming, **options)


def decode(
    messages: DataFrame,
    table: str,
    *,
    payload: str = "payload",
    counts: Observation | str | None = None,
) -> DataFrame:
    """JSON payloads to contract columns plus the event time ``ts``.

    Each field is read as text and then cast on its own, because a typed JSON
    read turns a number written as a string into null. Unreadable messages are
    skipped. Under the observation ``counts``, by default named
    ``decode_<table>``, the query reports how many messages were read, how many
    were skipped, in how many a field did not fit its type, and how many have
    no event time at all: those stay, but belong to no window. ``rejects``
    gives the messages that were skipped or lack a time.
    """
    contract = schemas.EVENT_TABLES[table]
    text = T.StructType(all_text(contract).fields + [T.StructField(_BROKEN, T.StringType())])
    parsed = messages.select(
        F.from_json(
            F.col(payload), text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
        ).alias("r")
    )
    broken = F.col("r").isNull() | F.col(f"r.{_BROKEN}").isNotNull()
    # every field is cast once; counting misfits only compares the two sides
    cast = parsed.select(
        "r",
        broken.alias("broken"),
        *[coerce(F.col(f"r.{f.name}"), _computing(f.dataType)).alias(f.name) for f in contract.fields],
        parse_time(F.col("r.timestamp")).alias("ts"),
    )
    lost = [F.col(f"r.{f.name}").isNotNull() & F.col(f.name).isNull() for f in contract.fields]
    lost.append(F.col("r.timestamp").isNotNull() & F.col("ts").isNull())
    return (
        cast.observe(
            f"decode_{table}" if counts is None else counts,
            F.count(F.lit(1)).alias("records"),
            F.count(F.when(F.col("broken"), 1)).alias("malformed"),
            F.count(F.when(~F.col("broken") & any_of(lost), 1)).alias("misfits"),
            F.count(F.when(~F.col("broken") & F.col("r.timestamp").isNull(), 1)).alias("timeless"),
        )
        .filter(~F.col("broken"))
        .drop("r", "broken")
    )


def rejects(messages: DataFrame, table: str, *, payload: str = "payload") -> DataFrame:
    """Messages that enter no window, as they came, with the reason: malformed, or without a usable time."""
    text = T.StructType(
        all_text(schemas.EVENT_TABLES[table]).fields + [T.StructField(_BROKEN, T.StringType())]
    )
    read = F.from_json(F.col(payload), text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    reason = (
        F.when(F.col("r").isNull() | F.col(f"r.{_BROKEN}").isNotNull(), "malformed")
        .when(F.col("r.timestamp").isNull(), "no time")
        .when(parse_time(F.col("r.timestamp")).isNull(), "unreadable time")
    )
    return (
        messages.select(F.col(payload).alias("payload"), read.alias("r"))
        .select("payload", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def _computing(kind: T.DataType) -> T.DataType:
    """Measurements are computed with at full width; only the archive stores them as floats."""
    return T.DoubleType() if isinstance(kind, T.FloatType) else kind


def normalize(
    events: DataFrame, table: str, ingested_at=None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Contract columns only, in contract order and type, stamped with one arrival time.

    ``keep`` names further columns to carry along unchanged.
    """
    contract = schemas.EVENT_TABLES[table]
    present = {f.name: f.dataType for f in events.schema.fields}

    def column(field: T.StructField):
        if field.name == "timestamp" and "ts" in present:
            written = iso_time(F.col("ts"))
            return F.coalesce(F.col("timestamp"), written) if "timestamp" in present else written
        if field.name not in present:
            return F.lit(None).cast(field.dataType)
        source = F.col(field.name)
        if present[field.name] == field.dataType:
            return source
        if isinstance(field.dataType, T.StringType):
            return source.cast("string")
        if isinstance(present[field.name], T.StringType):
            return coerce(source, field.dataType)
        return source.try_cast(field.dataType.simpleString())

    ts = F.col("ts") if "ts" in present else parse_time(F.col("timestamp"))
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return events.select(
        *[column(f).alias(f.name) for f in contract.fields],
        ts.alias("ts"),
        stamp.alias("ingested_at"),
        *keep,
    )


def with_defaults(events: DataFrame, table: str) -> DataFrame:
    """Missing values replaced by the contract's defaults, unknown keys by UNKNOWN."""
    fills = dict(schemas.CONTRACT_DEFAULTS[table])
    fills["line_id"] = schemas.UNKNOWN
    if table == "equipment_status":
        fills["equipment_id"] = schemas.UNKNOWN
    return events.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value))
            for name, value in fills.items()
            if name in events.columns
        }
    )


def once_each(events: DataFrame) -> DataFrame:
    """A watermarked stream without repeated deliveries.

    Producers deliver at least once, so an event may come again. Events of one
    ``event_id`` count once; events without an id count once if they agree in
    every column. An id is remembered until the watermark has passed its event,
    which bounds the state to the events of the delay; a repetition that comes
    later is too late for every job.
    """
    whole = F.sha2(F.to_json(F.struct(*events.columns)), 256)
    keyed = events.withColumns(
        {"_id": F.col("event_id").cast("string"), "_same": F.when(F.col("event_id").isNull(), whole)}
    )
    return keyed.dropDuplicatesWithinWatermark(["_id", "_same"]).drop("_id", "_same")
