"""Running totals of a stream, held in Spark's state store.

The dashboard's counts by category are sums over everything that was sold so far. Instead of adding up all
stored batches at each look, one stateful aggregation keeps the totals of all categories: an event counts for its
gender, its payment method and so on, the state has a row per category and value, and a batch gives out the
rows that it changed (update mode). They are stored like a metric, under the batch's marker, so a replayed batch
replaces itself; a reader takes the newest row of every category and value.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.customer import with_age_group
from tallyhouse.schema import BATCH_COLUMN
from tallyhouse.sinks.metrics import audited, store_metric
from tallyhouse.sources.events import parse_events
from tallyhouse.sources.metric_store import FORMAT, compact_batches, read_metric
from tallyhouse.streaming.driver import TRIGGER, refuse_foreign_batches

LIVE_TABLE = "live_totals"
CATEGORIES = ("gender", "age_group", "payment_method", "transaction_status", "location_store")
_READ = ("gender", "age", "payment_method", "transaction_status", "location_store")
_MEASURES = ("customer_id", "order_id", "total_sales_amount", "quantity_sold")
_TOTALS = ("customer_count", "orders_count", "total_sales_amount", "total_quantity_sold")
COMPACT_EVERY = 100


def totals_by_category(events: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Totals per category and value, of a batch or, kept as state, of a stream of events."""
    events = with_age_group(events) if "age_group" in categories else events
    named = [
        F.struct(F.lit(name).alias("category"), F.col(name).cast("string").alias("value")) for name in categories
    ]
    each = events.select(F.explode(F.array(*named)).alias("of"), *_MEASURES)
    return each.groupBy("of.category", "of.value").agg(
        F.count("customer_id").alias("customer_count"),
        F.count("order_id").alias("orders_count"),
        F.sum("total_sales_amount").alias("total_sales_amount"),
        F.sum("quantity_sold").cast("bigint").alias("total_quantity_sold"),
    )


def run_live_totals(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    categories: Sequence[str] = CATEGORIES,
    trigger: str = TRIGGER,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
    fmt: str = FORMAT,
) -> StreamingQuery:
    """Start the job that keeps the totals of a stream of messages. The state lies in the checkpoint: a
    restarted job goes on with it. The root must be one of its own, not that of the metrics."""
    spark = messages.sparkSession
    refuse_foreign_batches(spark, root, checkpoint)
    totals = totals_by_category(parse_events(messages, [*_READ, *_MEASURES]), categories)

    def store(changed: DataFrame, batch_id: int) -> None:
        stored = audited(changed, datetime.now(timezone.utc))
        store_metric(stored, root, LIVE_TABLE, batch_id, fmt=fmt)
        if batch_id and batch_id % compact_every == 0:
            compact_batches(changed.sparkSession, root, [LIVE_TABLE], fmt=fmt)

    writer = totals.writeStream.outputMode("update").foreachBatch(store)
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return timed.option("checkpointLocation", checkpoint).start()


def read_live_totals(spark: SparkSession, root: str, fmt: str = FORMAT) -> DataFrame:
    """The totals as of the newest batch: of every category and value the row that was stored last."""
    rows = read_metric(spark, root, LIVE_TABLE, fmt=fmt)
    newest = F.max_by(F.struct(*_TOTALS), BATCH_COLUMN).alias("newest")
    return rows.groupBy("category", "value").agg(newest).select("category", "value", "newest.*")
