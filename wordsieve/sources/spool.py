"""A queue of messages in a folder, as a Spark source and sink for queues that have no connector.

A segment is a file of lines, one message each, named by the number of its first message and how many it has, so that its
place in the queue is told without reading it. A file beside it (``.at``) holds the bytes at which every so many of its
messages begin. A file named ``acked`` holds the number up to which the reader has finished.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from wordsieve.session import share_package

SCHEMA = "seq bigint, key string, value string"
# Fixed value: how many messages a reader may hold that it has not finished.
PREFETCH = 200

# Messages from one noted place in a segment to the next, which bounds what a slice passes over before it begins.
STRIDE = 256


def use_spool(spark: SparkSession) -> None:
    """Make the format ``spool`` known to a session. The folder given as ``path`` is one that all machines share."""
    share_package(spark)
    spark.dataSource.register(Spool)


def segments(path: str) -> list[tuple[int, int, str]]:
    """First number, count and name of the segments, in order."""
    found = []
    for name in os.listdir(path) if os.path.isdir(path) else []:
        if name.endswith(".jsonl") and not name.startswith("."):
            first, count = name.split("-")[:2]
            found.append((int(first), int(count), name))
    return sorted(found)


def acked(path: str) -> int:
    """The number of the first message that is not finished."""
    try:
        return int(Path(path, "acked").read_text())
    except FileNotFoundError:
        return 0


def _end(path: str) -> int:
    return max((first + count for first, count, _ in segments(path)), default=0)


@dataclass
class Slice(InputPartition):
    """The messages from one place to another in a segment, which begins with the number ``base``."""

    file: str
    base: int
    begin: int
    end: int


def _slices(path: str, begin: int, end: int, most: int | None = None) -> list[Slice]:
    """The messages of a range by segment, and of a segment up to ``most`` in a slice."""
    found = []
    for first, count, name in segments(path):
        low, high = max(begin, first), min(end, first + count)
        step = most or max(high - low, 1)
        found += [Slice(os.path.join(path, name), first, k, min(k + step, high)) for k in range(low, high, step)]
    return found


def _place(part: Slice) -> tuple[int, int]:
    """The last noted place in a segment at or before a slice: the number of its message and its byte."""
    try:
        with open(f"{part.file}.at", "rb") as places:
            passed = (part.begin - part.base) // STRIDE
            places.seek(8 * passed)
            noted = places.read(8)
    except FileNotFoundError:
        noted = b""
    return (part.base + passed * STRIDE, int.from_bytes(noted, "little")) if len(noted) == 8 else (part.base, 0)


def _rows(part: Slice) -> Iterator[tuple]:
    first, at = _place(part)
    with open(part.file, "rb") as lines:
        lines.seek(at)
        for seq, line in enumerate(lines, first):
            if seq >= part.end:
                break
            if seq >= part.begin:
                said = json.loads(line)
                yield seq, said.get("key"), said.get("value")


class Spool(DataSource):
    """Options: ``path``; ``prefetch``, how many messages a reader may hold; ``readers``, how many read side by side, 1 if not given.
    A batch holds up to what all of them may hold."""

    @classmethod
    def name(cls) -> str:
        return "spool"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return SpoolReader(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return SpoolStream(self.options["path"], int(self.options.get("prefetch", PREFETCH)), int(self.options.get("readers", 1)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SpoolWriter(self.options["path"], schema.fieldNames())

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return SpoolStreamWriter(self.options["path"], schema.fieldNames())


class SpoolReader(DataSourceReader):
    """All messages, finished or not."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> Sequence[Slice]:
        return _slices(self.path, 0, _end(self.path)) or [Slice("", 0, 0, 0)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        return _rows(partition) if partition.file else iter(())


class SpoolStream(DataSourceStreamReader):
    """Messages in order, at most ``prefetch`` a batch for each of the readers, which are tasks. A batch is finished, and its place
    noted, only when its sink has committed."""

    def __init__(self, path: str, prefetch: int, readers: int = 1):
        self.path, self.prefetch, self.readers = path, prefetch, readers
        self.planned = acked(path)

    def initialOffset(self) -> dict:  # noqa: N802
        # What an earlier reader has not finished comes again.
        return {"seq": acked(self.path)}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"seq": min(_end(self.path), max(self.planned, acked(self.path)) + self.prefetch * self.readers)}

    def partitions(self, start: dict, end: dict) -> Sequence[Slice]:
        self.planned = max(self.planned, end["seq"])
        return _slices(self.path, start["seq"], end["seq"], self.prefetch)

    def read(self, partition: Slice) -> Iterator[tuple]:
        return _rows(partition)

    def commit(self, end: dict) -> None:
        if end["seq"] > acked(self.path):
            begun = Path(self.path, f".{uuid.uuid4().hex}")
            begun.write_text(str(end["seq"]))
            begun.rename(Path(self.path, "acked"))


@dataclass
class Written(WriterCommitMessage):
    part: int
    count: int
    file: str


class SpoolWriter(DataSourceWriter):
    """Tasks write segments under hidden names; they get their places in the queue when all are done."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names
        os.makedirs(path, exist_ok=True)

    def write(self, iterator: Iterator) -> Written:
        key, value = self.names.index("key") if "key" in self.names else None, self.names.index("value")
        name, count, at = os.path.join(self.path, f".{uuid.uuid4().hex}"), 0, 0
        with open(name, "wb") as out, open(f"{name}.at", "wb") as places:
            for row in iterator:
                if count % STRIDE == 0:
                    places.write(at.to_bytes(8, "little"))
                at += out.write(json.dumps({"key": None if key is None else row[key], "value": row[value]}).encode() + b"\n")
                count += 1
        return Written(TaskContext.get().partitionId(), count, name)

    def _append(self, messages: Sequence[Written | None], tag: str) -> None:
        first = _end(self.path)
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            if m.count:
                name = os.path.join(self.path, f"{first:012d}-{m.count}-{tag}-{m.part}.jsonl")
                # The places first, so that a segment that is seen has them.
                if os.path.exists(f"{m.file}.at"):
                    os.rename(f"{m.file}.at", f"{name}.at")
                os.rename(m.file, name)
                first += m.count
            else:
                self._drop([m])

    def _drop(self, messages: Sequence[Written | None]) -> None:
        for m in messages:
            for name in () if m is None else (m.file, f"{m.file}.at"):
                if os.path.exists(name):
                    os.unlink(name)

    def commit(self, messages: Sequence[Written | None]) -> None:
        self._append(messages, uuid.uuid4().hex)

    def abort(self, messages: Sequence[Written | None]) -> None:
        self._drop(messages)


class SpoolStreamWriter(DataSourceStreamWriter):
    """One writer to a spool. A batch that is run again replaces what is left of it, and adds nothing once it is all there."""

    def __init__(self, path: str, names: list[str]):
        self.inner = SpoolWriter(path, names)

    def write(self, iterator: Iterator) -> Written:
        return self.inner.write(iterator)

    def commit(self, messages: Sequence[Written | None], batchId: int) -> None:  # noqa: N803
        there = {name.split("-")[3][:-6] for _, _, name in segments(self.inner.path) if name.split("-")[2] == f"b{batchId}"}
        # Segments that a lost driver had placed already stay as they are; the batch's other parts follow.
        placed = [m for m in messages if m is not None and str(m.part) in there]
        self.inner._drop(placed)
        self.inner._append([m for m in messages if m is not None and str(m.part) not in there], f"b{batchId}")

    def abort(self, messages: Sequence[Written | None], batchId: int) -> None:  # noqa: N803
        self.inner._drop(messages)
