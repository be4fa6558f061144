"""What became of each batch of the streaming queries, stored as it happens."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import (
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from tallyhouse.sources.metric_store import path_holds_files, write_text

PROGRESS = (
    "event string, query string, run string, name string, batch_id bigint, moment string, input_rows bigint, "
    "rows_per_second double, duration_ms bigint, state_rows bigint, error string"
)


class ProgressLog(StreamingQueryListener):
    """Stores a line of JSON for the start and the end of a query and for each of its batches: rows read, time
    taken, rows held as state, and the error that ended the query. Each line is a file of its own, so neither a
    restart nor a second query touches what is there."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _store(self, event: str, query: str, run: str, part: str, **values) -> None:
        line = {"event": event, "query": query, "run": run, **values}
        write_text(self.spark, f"{self.root}/{run}-{part}.json", json.dumps(line) + "\n")

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._store("started", str(event.id), str(event.runId), "start", name=event.name, moment=event.timestamp)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        self._store(
            "progress",
            str(p.id),
            str(p.runId),
            f"{p.batchId:020d}",
            name=p.name,
            batch_id=p.batchId,
            moment=p.timestamp,
            input_rows=p.numInputRows,
            rows_per_second=p.processedRowsPerSecond,
            duration_ms=p.durationMs.get("triggerExecution"),
            state_rows=sum(state.numRowsTotal for state in p.stateOperators),
        )

    def onQueryIdle(self, event) -> None:
        """A trigger without new data is no batch."""

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._store("terminated", str(event.id), str(event.runId), "end", error=event.exception)


def log_progress(spark: SparkSession, root: str) -> ProgressLog:
    """Store the progress of all the session's queries below root, until the listener is removed."""
    listener = ProgressLog(spark, root)
    spark.streams.addListener(listener)
    return listener


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """All stored lines; no rows where there are none."""
    if not path_holds_files(spark, root):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(root)
