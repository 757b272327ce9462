"""A topic without a broker: append-only message files, read as a stream with offsets.

A topic is a folder of files, one message per line. A file is a partition of
the topic; it only ever grows, by whole lines, and new files may appear in the
folder or below it. The stream's offset says for each file up to which byte it
has been read, so a restarted query goes on where its checkpoint stands, and
reads no line twice and none in part. A last line without its line feed is
still being written and waits.

    spark.dataSource.register(MessageLog)
    spark.readStream.format("message_log").option("path", folder).load()

``starting`` is ``earliest`` or ``latest``, as for a broker's topic; with
``latest``, files that appear later are read from their beginning. Tasks read
``split_bytes`` each, so a long backlog spreads over many. The folder must be
mounted where the driver and all executors run; names that begin with a dot or
an underscore are not messages.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# readers travel to the workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 32 << 20
_BLOCK = 1 << 20


@dataclass
class Span(InputPartition):
    """Whole lines of a file: those that begin in the bytes from ``start`` to ``end``."""

    file: str
    start: int
    end: int


def complete(path: str, known: int = 0) -> int:
    """The length of a file up to its last line feed, which lies at ``known`` or behind it."""
    with open(path, "rb") as file:
        end = file.seek(0, os.SEEK_END)
        while end > known:
            begin = max(known, end - _BLOCK)
            file.seek(begin)
            found = file.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return known


def lines(path: str, start: int, end: int) -> Iterator[str]:
    """Lines that begin in a span. Only a span that does not begin with a line skips to the next one."""
    with open(path, "rb") as file:
        if start:
            file.seek(start - 1)
            file.readline()
        while file.tell() < end:
            line = file.readline()
            if not line.endswith(b"\n"):
                return
            yield line[:-1].decode("utf-8", "replace")


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://").removeprefix("file:")
        self.starting = options.get("starting", "earliest")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.known: dict[str, int] = {}
        if self.starting not in ("earliest", "latest"):
            raise ValueError(f"starting is earliest or latest, not {self.starting}")

    def _files(self) -> list[str]:
        found = []
        for top, folders, names in os.walk(self.folder):
            folders[:] = [f for f in folders if f[0] not in "._"]
            found += [os.path.relpath(os.path.join(top, n), self.folder) for n in names if n[0] not in "._"]
        return sorted(found)

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.starting == "latest" else {}

    def latestOffset(self) -> dict:
        # bytes once found complete stay so
        self.known = {f: complete(os.path.join(self.folder, f), self.known.get(f, 0)) for f in self._files()}
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        spans = []
        for file, stop in sorted(end.items()):
            begin = start.get(file, 0)
            spans += [Span(file, at, min(at + self.split, stop)) for at in range(begin, stop, self.split)]
        return spans

    def read(self, partition: Span) -> Iterator[tuple]:
        for line in lines(os.path.join(self.folder, partition.file), partition.start, partition.end):
            yield (line, partition.file)

    def commit(self, end: dict) -> None:
        """Nothing to do: the files stay, and the checkpoint has the offsets."""


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "payload string, partition string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MessageLogReader(self.options)


def message_feed(spark: SparkSession, folder: str, *, starting: str = "earliest", **options: str) -> DataFrame:
    """Messages of a topic folder as one ``payload`` text column, as ``feeds.topic_feed`` gives those of a broker."""
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format("message_log").option("path", folder).option("starting", starting)
    return reader.options(**options).load().select("payload")
