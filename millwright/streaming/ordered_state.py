"""Keyed operators that see each key's rows in event-time order.

Micro-batches deliver rows in no particular order. ``InOrder`` keeps them in
map state, cut into slots of event time, and wakes by an event-time timer when
the watermark has passed the earliest; then it hands the due ones, in order,
to the operator's ``step`` together with the operator's memory, one typed value
per key. The operator says how long its memory matters; a timer clears it after
that.

A slot's rows are sorted alone, rows arrive and results leave in frames of
bounded size, so a worker holds one slot of one key at a time, however many
rows a micro-batch brings. All states are typed columns in RocksDB, so a key
costs its own rows and no more, and a restarted query goes on from its
checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millwright import schemas
from millwright.functions.numeric import seconds_between
from millwright.operators.precursors import SLOT_S, alert_columns, in_slots, signal_rows
from millwright.sources.feeds import BEAT, once_each

# operators travel to the workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DELAY = f"{schemas.WATERMARK_S} seconds"
_ORDER = "us bigint, event_key bigint, event_id string"
#: width of a slot of waiting rows; rows dealt to slots together; results handed on together
WAIT_US = 3_600_000_000
DEALT_ROWS = 50_000
OUT_ROWS = 5_000


class InOrder(StatefulProcessor):
    """Rows of a key in order; subclasses name their columns and say what a row does.

    ``columns`` follow the order columns in the waiting rows; ``memory_layout``
    is the type of what ``step`` remembers.
    """

    columns: str
    memory_layout: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        layout = [part.split() for part in f"{_ORDER}, {self.columns}".split(", ")]
        self.names = [name for name, _ in layout]
        # a slot's rows come in parts, column by column
        self.waiting = handle.getMapState(
            "waiting", "slot bigint, part bigint", ", ".join(f"{name} array<{kind}>" for name, kind in layout)
        )
        self.slots = handle.getMapState("slots", "slot bigint", "parts bigint, first_us bigint")
        self.memory = handle.getValueState("memory", self.memory_layout)

    def step(self, key: tuple, memory: tuple | None, row: dict) -> tuple[tuple | None, Row | None]:
        """What is remembered after the row, and what it makes known."""
        raise NotImplementedError

    def matters_until(self, memory: tuple) -> int | None:
        """The last microsecond at which the memory can matter; None: always."""
        return None

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        earliest, held, count = None, [], 0

        def deal() -> None:
            nonlocal earliest, held, count
            first = self._deal(pd.concat(held, ignore_index=True))
            earliest = first if earliest is None else min(earliest, first)
            held, count = [], 0

        for frame in rows:
            held.append(frame[self.names])
            count += len(frame)
            if count >= DEALT_ROWS:
                deal()
        if count:
            deal()
        if earliest is not None:
            self._wake(earliest)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        slots = sorted((first, slot, parts) for (slot,), (parts, first) in self.slots.iterator())
        due = [one for one in slots if one[0] < watermark]
        still = [first for first, _, _ in slots[len(due) :]]
        memory = self.memory.get() if self.memory.exists() else None
        memory = None if memory is None else tuple(memory)
        found: list[Row] = []
        for _, slot, parts in due:
            rows = self._taken(slot, parts)
            rest = [row for row in rows if row[0] >= watermark]
            if rest:
                self._keep(slot, 0, list(zip(*rest)))
                still.append(rest[0][0])
            for row in rows[: len(rows) - len(rest)]:
                memory, known = self.step(key, memory, dict(zip(self.names, row)))
                if known is not None:
                    found.append(known)
                if len(found) >= OUT_ROWS:
                    yield _frame(found)
                    found = []
        if found:
            yield _frame(found)
        if due and still:
            self._wake(min(still))
        until = None if memory is None else self.matters_until(memory)
        if memory is None or (until is not None and until < watermark):
            self.memory.clear()
        elif due:
            self.memory.update(memory)
            if until is not None:
                self._wake(until)

    def _deal(self, rows: pd.DataFrame) -> int:
        """Adds the rows to the waiting ones of their slots; the earliest microsecond among them."""
        if rows["us"].isna().any():
            raise ValueError("a row without an event time has no place in the order")
        slot = rows["us"].to_numpy() // WAIT_US
        order = np.argsort(slot, kind="stable")
        edges = np.flatnonzero(np.diff(slot[order])) + 1
        columns = [rows[name].to_numpy()[order] for name in self.names]
        for a, b in zip([0, *edges], [*edges, len(order)]):
            at = (int(slot[order[a]]),)
            parts, first = self.slots.getValue(at) or (0, None)
            low = int(columns[0][a:b].min())
            self._keep(at[0], parts, [column[a:b].tolist() for column in columns], low if first is None else min(first, low))
        return int(columns[0].min())

    def _keep(self, slot: int, part: int, columns: list, first: int | None = None) -> None:
        self.waiting.updateValue((slot, part), tuple(list(column) for column in columns))
        self.slots.updateValue((slot,), (part + 1, columns[0][0] if first is None else first))

    def _taken(self, slot: int, parts: int) -> list[tuple]:
        """The waiting rows of a slot in order, which wait no longer."""
        rows: list[tuple] = []
        for part in range(parts):
            rows += zip(*self.waiting.getValue((slot, part)))
            self.waiting.removeKey((slot, part))
        self.slots.removeKey((slot,))
        return sorted(rows, key=lambda row: row[:3])

    def _wake(self, us: int) -> None:
        """Once the watermark is past the microsecond."""
        self.handle.registerTimer(us // 1000 + 1)


def _frame(rows: list[Row]) -> pd.DataFrame:
    return pd.DataFrame([tuple(row) for row in rows], columns=rows[0].__fields__)


class Precursors(InOrder):
    """An alert for each fault whose neighbour before it is an arming reading of the last seconds."""

    columns = "line_id string, is_fault boolean, temperature_c double, fault_code string, at_home boolean"
    memory_layout = "us bigint, is_fault boolean, temperature_c double"

    def __init__(self, within_us: int):
        self.within = within_us

    def step(self, key: tuple, memory: tuple | None, row: dict) -> tuple[tuple | None, Row | None]:
        after = (row["us"], row["is_fault"], row["temperature_c"])
        hit = row["is_fault"] and row["at_home"] and memory is not None and not memory[1]
        if not hit or row["us"] - memory[0] > self.within:
            return after, None
        return after, Row(
            us=row["us"], equipment_id=key[0], line_id=row["line_id"], temperature_c=memory[2],
            fault_code=row["fault_code"], event_id=row["event_id"],
        )

    def matters_until(self, memory: tuple) -> int | None:
        return memory[0] - 1 if memory[1] else memory[0] + self.within


class Intervals(InOrder):
    """A finished interval whenever a machine's status changes; the running one stays in memory."""

    columns = "line_id string, status string"
    memory_layout = "status string, us bigint, line_id string"

    def step(self, key: tuple, memory: tuple | None, row: dict) -> tuple[tuple | None, Row | None]:
        if memory is not None and memory[0] == row["status"]:
            return memory, None
        after = (row["status"], row["us"], row["line_id"])
        if memory is None:
            return after, None
        return after, Row(equipment_id=key[0], line_id=memory[2], status=memory[0], started_us=memory[1], ended_us=row["us"])


def _order_columns(rows: DataFrame) -> list:
    """Whole-numbered ids are ordered as numbers, others as text; none comes first."""
    whole = isinstance(rows.schema["event_id"].dataType, T.IntegralType)
    number = F.coalesce(F.col("event_id").cast("bigint"), F.lit(-(2**63))) if whole else F.lit(0).cast("bigint")
    return [
        F.unix_micros("ts").alias("us"),
        number.alias("event_key"),
        F.coalesce(F.col("event_id").cast("string"), F.lit("")).alias("event_id"),
    ]


def _applied(rows: DataFrame, keys: list[str], operator: InOrder, layout: str) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return rows.groupBy(*keys).transformWithStateInPandas(operator, layout, "append", "eventTime")


def precursor_stream(
    status: DataFrame,
    *,
    high_temperature: float = schemas.HIGH_TEMPERATURE_C,
    high_vibration: float = schemas.HIGH_VIBRATION_HZ,
    within_s: int = schemas.PRECURSOR_WINDOW_S,
    slot_s: int = SLOT_S,
    delay: str = _DELAY,
    distinct: bool = False,
) -> DataFrame:
    """Alerts of a status stream, in the columns of the batch operator; state per machine and time slot.

    Benign readings must advance the watermark too, or a quiet machine would
    hold back the alerts of all others. The optimizer would move the signal
    filter below the watermark; a term on the event time, never true, keeps it
    above.
    """
    readings = status.withWatermark("ts", delay)
    rows = signal_rows(
        once_each(readings) if distinct else readings,
        high_temperature=high_temperature,
        high_vibration=high_vibration,
        or_else=F.col("ts") < F.lit("0001-01-01 00:00:00").cast("timestamp"),
    )
    slots = in_slots(rows, within_s, slot_s)
    keyed = slots.select(
        "equipment_id", "slot", "ts", *_order_columns(slots), "line_id", "is_fault", "temperature_c", "fault_code",
        (F.col("slot") == F.col("home")).alias("at_home"),
    )
    layout = "us bigint, equipment_id string, line_id string, temperature_c double, fault_code string, event_id string"
    found = _applied(keyed, ["equipment_id", "slot"], Precursors(within_s * 1_000_000), layout)
    return found.withColumn("ts", F.timestamp_micros("us")).select(*alert_columns(F.col("temperature_c")))


def interval_stream(status: DataFrame, *, delay: str = _DELAY, distinct: bool = False) -> DataFrame:
    """Finished status intervals of a status stream, as the batch operator gives them."""
    readings = status.withWatermark("ts", delay)
    rows = once_each(readings) if distinct else readings
    if BEAT in status.columns:
        # the term on the event time, never true, keeps the filter above the watermark
        rows = rows.filter(~F.col(BEAT) | (F.col("ts") < F.lit("0001-01-01 00:00:00").cast("timestamp")))
    keyed = rows.select(
        F.coalesce("equipment_id", F.lit(schemas.UNKNOWN)).alias("equipment_id"), "ts", *_order_columns(rows),
        F.coalesce("line_id", F.lit(schemas.UNKNOWN)).alias("line_id"), F.coalesce("status", F.lit("")).alias("status"),
    )
    layout = "equipment_id string, line_id string, status string, started_us bigint, ended_us bigint"
    found = _applied(keyed, ["equipment_id"], Intervals(), layout)
    started, ended = F.timestamp_micros("started_us"), F.timestamp_micros("ended_us")
    return found.select(
        "equipment_id", "line_id", "status", started.alias("started"), ended.alias("ended"),
        seconds_between(started, ended).alias("seconds"),
    )
