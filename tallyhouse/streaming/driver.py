"""The streaming job: messages in, stored metrics out, batch by batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.functions.concurrency import WIDTH, run_together
from tallyhouse.operators.catalogue import APPEND, METRICS, REPLACE, Metric, columns_of
from tallyhouse.operators.customer import rfm
from tallyhouse.operators.distribution import monetary_sketch
from tallyhouse.operators.mergeable import STATE_OF, STATES, state_of, traffic_sketch
from tallyhouse.operators.regression import (
    FEATURE,
    LABEL,
    MODEL_COLUMNS,
    fit_sales_model,
    predict_sales,
    regression_mse,
)
from tallyhouse.plans.microbatch import MetricGroup, compute_metric, metric_groups
from tallyhouse.sinks.metrics import KEPT_BATCHES, audited, batch_attempt, write_rows
from tallyhouse.sources.events import event_schema, flat_events, loss_counts, losses, parse_payload
from tallyhouse.sources.metric_store import (
    FORMAT,
    attempt_path,
    committed,
    compact_batches,
    expire_batches,
    newest_of,
    path_holds_files,
)

TRIGGER = "40 seconds"
REGRESSION_TABLE, PREDICTIONS_TABLE = "sales_regression", "sales_predictions"
MODEL_TABLE, ERRORS_TABLE = "sales_model", "batch_errors"
REJECTS_TABLE, LOSSES_TABLE, LOSS_COUNTS_TABLE = "rejects", "losses", "loss_counts"
TRAFFIC_STATE, MONETARY_STATE = "website_traffic_state", "monetary_state"
COMPACT_EVERY = 500

#: Writes one table, or several, of an attempt at a batch.
Write = Callable[[int], None]


def _fill(df: DataFrame) -> None:
    """Compute all blocks of a persisted frame by one job, before several jobs read it: jobs that
    start together would each compute what none has stored yet."""
    df.write.format("noop").mode("overwrite").save()


class _Tables:
    """What the writes of one batch have in common."""

    def __init__(self, root: str, batch_id: int, moment: datetime, fmt: str, preview: bool) -> None:
        self.root, self.batch_id, self.moment, self.fmt, self.preview = root, batch_id, moment, fmt, preview

    def store(self, df: DataFrame, name: str, attempt: int, row_uuid: bool = False) -> None:
        stored = audited(df, self.moment, row_uuid)
        if self.preview:
            stored.show()
        write_rows(stored, self.root, name, self.batch_id, attempt, self.fmt)

    def store_group(self, group: MetricGroup, attempt: int) -> None:
        """The metrics of a base one after the other: the first one fills the base, the others read it. Groups
        run side by side, so no group waits for the base of another."""
        frame = group.frame.persist() if group.shared else group.frame
        try:
            for metric in group.metrics:
                result = compute_metric(metric, frame, as_of=int(self.moment.timestamp()))
                self.store(result, metric.table, attempt, metric.row_uuid)
        finally:
            if group.shared:
                frame.unpersist()

    def store_states(self, events: DataFrame, metrics: Iterable[Metric]) -> list[Write]:
        """What distinct counts over several batches need of this one."""
        names = {metric.name for metric in metrics}
        tables = {STATE_OF[name].table for name in names & STATE_OF.keys()}
        writes = [partial(self.store, state_of(events, STATES[table]), table) for table in sorted(tables)]
        if "website_traffic" in names:
            writes.append(partial(self.store, traffic_sketch(events), TRAFFIC_STATE))
        if "rfm" in names:
            writes.append(partial(self.store, monetary_sketch(rfm(events)), MONETARY_STATE))
        return writes

    def store_error(self, task: str, error: Exception, attempt: int, spark: SparkSession) -> None:
        logging.getLogger(__name__).error("%s of batch %d", task, self.batch_id, exc_info=error)
        row = spark.createDataFrame([(task, f"{type(error).__name__}: {error}")], "task string, message string")
        self.store(row, ERRORS_TABLE, attempt)

    def store_predictions(self, events: DataFrame, refit_every: int, attempt: int) -> None:
        """Predictions and their error: by a model fitted to the batch, which is stored with it, or, between
        two fits, by the newest stored model. An error leaves the metrics alone and is stored as a row."""
        spark = events.sparkSession
        known = events.select(*MODEL_COLUMNS).dropna(subset=[FEATURE, LABEL])
        if known.isEmpty():
            return
        try:
            stored = newest_of(spark, self.root, MODEL_TABLE)
            if stored is not None and self.batch_id - stored[0] < refit_every and stored[0] < self.batch_id:
                fitted, model = stored[0], PipelineModel.load(stored[1])
            else:
                fitted, model = self.batch_id, fit_sales_model(known)
                model.write().overwrite().save(attempt_path(self.root, MODEL_TABLE, self.batch_id, attempt))
            of_model = F.lit(fitted).cast("bigint").alias("model_batch_id")
            predictions = predict_sales(model, known)
            self.store(predictions.select("*", of_model), PREDICTIONS_TABLE, attempt)
            self.store(regression_mse(predictions).select("*", of_model), REGRESSION_TABLE, attempt)
        except Exception as error:  # noqa: BLE001
            self.store_error("regression", error, attempt, spark)


def write_batch(
    events: DataFrame,
    root: str,
    batch_id: int,
    metrics: Iterable[Metric] = tuple(METRICS.values()),
    now: datetime | None = None,
    fused: bool = True,
    preview: bool = False,
    width: int = WIDTH,
    fmt: str = FORMAT,
    keep: int = KEPT_BATCHES,
    regression: bool = False,
    refit_every: int = 1,
    states: bool = False,
    extra: dict[str, DataFrame] | None = None,
    cached: bool = False,
) -> None:
    """Compute and store all metrics of one batch of events, and publish them together.

    The events and the bases that several metrics read are kept for the length of the batch, unless the
    caller keeps the events already (``cached``). Lost blocks are computed again from the source. ``extra``
    are further tables of the batch by name.
    """
    metrics = tuple(metrics)
    spark, moment = events.sparkSession, now or datetime.now(timezone.utc)
    tables = _Tables(root, batch_id, moment, fmt, preview)
    try:
        if not cached:
            events.persist()
            _fill(events)
        writes: list[Write] = [
            partial(tables.store_group, group) for group in metric_groups(events, metrics, fused)
        ]
        if states:
            writes += [lambda attempt, w=write: w(attempt=attempt) for write in tables.store_states(events, metrics)]
        if regression:
            writes.insert(0, partial(tables.store_predictions, events, refit_every))
        for name, frame in (extra or {}).items():
            writes.append(partial(tables.store, frame, name))
        with batch_attempt(spark, root, batch_id) as attempt:
            run_together(spark, [partial(write, attempt) for write in writes], width)
        replaced = [metric.table for metric in metrics if metric.mode == REPLACE]
        for table in replaced + [PREDICTIONS_TABLE, MODEL_TABLE] * regression:
            expire_batches(spark, root, table, keep)
    finally:
        if not cached:
            events.unpersist()


def batch_writer(
    root: str,
    metrics: Iterable[Metric] = tuple(METRICS.values()),
    regression: bool = True,
    keep_rejects: bool = True,
    states: bool = True,
    compact_every: int = COMPACT_EVERY,
    **options,
) -> Callable[[DataFrame, int], None]:
    """The function a stream calls per micro-batch of messages; an empty batch is skipped.

    The messages are read and parsed once, for the fields that are needed, and kept; metrics, regression,
    rejects and losses are consumers of that. The pass that parses them counts, by observed metrics, the messages
    and how many lost which field.
    """
    metrics = tuple(metrics)
    # The id of the sale is parsed with the model's columns, so that its loss is told too
    schema = event_schema([*columns_of(metrics), *((*MODEL_COLUMNS, "sales_id") if regression else ())])
    fmt = options.get("fmt", FORMAT)

    def appended() -> list[str]:
        tables = [m.table for m in metrics if m.mode == APPEND]
        tables += [REGRESSION_TABLE, ERRORS_TABLE] * regression
        tables += [REJECTS_TABLE, LOSSES_TABLE, LOSS_COUNTS_TABLE] * keep_rejects
        return tables + [*STATES, TRAFFIC_STATE, MONETARY_STATE] * states

    def process_batch(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        parsed = parse_payload(messages, schema)
        # Only the text of messages that were rejected or lost something is needed again
        told = F.col("malformed") | (F.size("lost") > 0)
        parsed = parsed.withColumn("payload", F.when(told, F.col("payload"))).persist()
        try:
            seen = Observation()
            _fill(parsed.observe(seen, *[count.alias(name) for name, count in loss_counts(schema).items()]))
            counts = seen.get
            if counts["messages"]:
                extra = {}
                if keep_rejects:
                    lost = [(name, n) for name, n in counts.items() if n and name in schema.names]
                    extra = {
                        REJECTS_TABLE: parsed.where("malformed").select("payload"),
                        LOSSES_TABLE: losses(parsed),
                        LOSS_COUNTS_TABLE: spark.createDataFrame(lost, "field string, messages long"),
                    }
                events = flat_events(parsed, schema)
                write_batch(
                    events, root, batch_id, metrics, regression=regression, states=states, extra=extra, cached=True,
                    **options,
                )
        finally:
            parsed.unpersist()
        if batch_id and batch_id % compact_every == 0:
            compact_batches(spark, root, appended(), fmt=fmt)

    return process_batch


def refuse_foreign_batches(spark: SparkSession, root: str, checkpoint: str) -> None:
    """A new checkpoint counts batches from 0 and would replace those of an older one."""
    if not path_holds_files(spark, checkpoint) and committed(spark, root):
        raise ValueError(
            f"{root} holds batches, but checkpoint {checkpoint} is new: use one root per checkpoint"
        )


def run_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    metrics: Iterable[Metric] = tuple(METRICS.values()),
    trigger: str = TRIGGER,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Start the job that stores metrics, their mergeable states, model, predictions and error of the
    regression, and rejected and partly lost messages of each micro-batch of a stream of messages.

    With the named checkpoint a restarted job goes on where it stopped. Options are those of
    :func:`batch_writer` and :func:`write_batch`: ``regression``, ``refit_every`` (batches that one model
    serves), ``keep_rejects``, ``states``, ``fused``, ``preview``, ``width`` (jobs at a time), ``fmt`` (format
    of the store), ``keep`` (batches of a replaced metric that stay) and ``compact_every`` (batches).
    """
    refuse_foreign_batches(messages.sparkSession, root, checkpoint)
    writer = messages.writeStream.foreachBatch(batch_writer(root, metrics, **options))
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return timed.option("checkpointLocation", checkpoint).start()


def await_streams(spark: SparkSession) -> None:
    """Wait until any of the session's streaming queries ends."""
    spark.streams.awaitAnyTermination()
