"""Topics recorded in files: partitions, offsets and keys of a message broker without one.

`spark.read`, `spark.readStream` and `df.write` with the format `topic_files` have the columns and the meaning
that the Kafka connector gives them, over a folder that all executors see under one path:

    <path>/<topic>/<partition>/<first offset>-<records>.jsonl      one record per line: key, value, time

A record's partition follows from the checksum of its key, so events of one key keep their order. Writing tasks
fill segments aside; when all of them are done their offsets are assigned and they are moved into place, one
rename each. Names hold the offsets, so what is new is found without opening a file, and a reading task opens only
segments that it needs. One writer at a time may write to a topic. A value that is null is a null value; a
record without a key goes to partition 0.

Options: `path`, `topic`, `startingOffsets` (`latest`, the default of a stream, `earliest`, the default of a batch,
or JSON from partition to offset), and for writing `partitions`, the number a new topic gets.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import Row, StructType

from tallyhouse.functions.folders import reach_workers

FORMAT = "topic_files"
_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
_ASIDE = "_writing"


def _segments(folder: str, partition: int) -> list[tuple[int, int, str]]:
    """(first offset, offset behind the last, path) of a partition's segments, in order."""
    where = os.path.join(folder, str(partition))
    found = []
    for name in os.listdir(where) if os.path.isdir(where) else ():
        first, _, count = name.removesuffix(".jsonl").partition("-")
        found.append((int(first), int(first) + int(count), os.path.join(where, name)))
    return sorted(found)


def _partitions(folder: str) -> list[int]:
    return sorted(int(n) for n in os.listdir(folder) if n.isdigit()) if os.path.isdir(folder) else []


def _ends(folder: str) -> dict[str, int]:
    return {str(p): max((end for _, end, _ in _segments(folder, p)), default=0) for p in _partitions(folder)}


@dataclass
class Range(InputPartition):
    """Offsets of one partition of the topic."""

    partition: int
    first: int
    end: int


class _Reading:
    def __init__(self, options: dict[str, str], default: str) -> None:
        self.topic = options["topic"]
        self.folder = os.path.join(options["path"].removeprefix("file://"), self.topic)
        self.starting = options.get("startingoffsets", default)

    def first_offsets(self) -> dict[str, int]:
        if self.starting == "earliest":
            return {}
        return _ends(self.folder) if self.starting == "latest" else json.loads(self.starting)

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        spans = [(int(p), start.get(p, 0), upto) for p, upto in end.items()]
        return [Range(p, first, upto) for p, first, upto in spans if first < upto]

    def records(self, part: Range) -> Iterator[tuple]:
        for first, end, path in _segments(self.folder, part.partition):
            if first >= part.end or end <= part.first:
                continue
            with open(path, encoding="utf-8") as lines:
                for offset, line in enumerate(lines, first):
                    if part.first <= offset < part.end:
                        record = json.loads(line)
                        key, value = (None if x is None else x.encode() for x in (record["key"], record["value"]))
                        moment = datetime.fromtimestamp(record["time"], timezone.utc)
                        yield (key, value, self.topic, part.partition, offset, moment)


class TopicStream(DataSourceStreamReader):
    """New records of all partitions; a restarted query goes on behind the offsets of its checkpoint."""

    def __init__(self, options: dict[str, str]) -> None:
        self.reading = _Reading(options, "latest")

    def initialOffset(self) -> dict:
        return self.reading.first_offsets()

    def latestOffset(self) -> dict:
        return _ends(self.reading.folder)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.reading.ranges(start, end)

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.reading.records(partition)


class TopicBatch(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.reading = _Reading(options, "earliest")

    def partitions(self) -> list[Range]:
        return self.reading.ranges(self.reading.first_offsets(), _ends(self.reading.folder)) or [Range(0, 0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.reading.records(partition)


@dataclass
class Written(WriterCommitMessage):
    """Segments of a task that wait for their offsets: (partition, path, records)."""

    segments: list[tuple[int, str, int]]


class TopicWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = os.path.join(options["path"].removeprefix("file://"), options["topic"])
        self.count = len(_partitions(self.folder)) or int(options.get("partitions", 1))
        for partition in range(self.count):
            os.makedirs(os.path.join(self.folder, str(partition)), exist_ok=True)
        os.makedirs(os.path.join(self.folder, _ASIDE), exist_ok=True)

    def write(self, rows: Iterator[Row]) -> Written:
        task, files, counts = uuid.uuid4().hex, {}, {}
        now = datetime.now(timezone.utc).timestamp()
        try:
            for row in rows:
                key, value = (None if x is None else x if isinstance(x, str) else bytes(x).decode() for x in (row["key"], row["value"]))
                partition = zlib.crc32(key.encode()) % self.count if key is not None else 0
                if partition not in files:
                    path = os.path.join(self.folder, _ASIDE, f"{task}-{partition}.jsonl")
                    files[partition] = open(path, "w", encoding="utf-8")  # noqa: SIM115
                files[partition].write(json.dumps({"key": key, "value": value, "time": now}) + "\n")
                counts[partition] = counts.get(partition, 0) + 1
        finally:
            for file in files.values():
                file.close()
        return Written([(p, file.name, counts[p]) for p, file in files.items()])

    def commit(self, messages: list[Written | None]) -> None:
        ends = _ends(self.folder)
        for partition, path, count in (s for m in messages if m for s in m.segments):
            first = ends[str(partition)]
            os.rename(path, os.path.join(self.folder, str(partition), f"{first:020d}-{count}.jsonl"))
            ends[str(partition)] = first + count

    def abort(self, messages: list[Written | None]) -> None:
        for _, path, _ in (s for m in messages if m for s in m.segments):
            os.remove(path)


class TopicFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema: StructType) -> TopicStream:
        return TopicStream(self.options)

    def reader(self, schema: StructType) -> TopicBatch:
        return TopicBatch(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("records are appended to a topic")
        return TopicWriter(self.options)


def register_topic_files(spark: SparkSession) -> None:
    """Make the format known to the session."""
    reach_workers(spark)
    spark.dataSource.register(TopicFiles)
