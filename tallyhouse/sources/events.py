"""Sales events from a stream of JSON messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import line_amount, session_end, session_seconds, utc_text
from tallyhouse.schema import MONEY, MONEY_COLUMNS, SALES_EVENT, SNAKE_NAMES, WIRE_NAMES

_CORRUPT = "_corrupt_record"


def read_events_stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Stream with a ``value`` column holding one JSON event per row.

    ``fmt="kafka"`` takes the connector's options, for instance
    ``**{"kafka.bootstrap.servers": ..., "subscribe": ...}``. ``minPartitions`` makes Spark read one
    busy topic partition with several tasks, and ``maxOffsetsPerTrigger`` bounds a micro-batch.
    ``fmt="text"`` reads a directory of JSON lines, given as ``path=...``.
    """
    return spark.readStream.format(fmt).options(**options).load()


def parse_payload(messages: DataFrame, schema: T.StructType = SALES_EVENT) -> DataFrame:
    """Messages with their text, the parsed event and whether the text is no JSON object.

    A field of the wrong type is null and leaves the other fields of its event alone. Only when
    every field came out null is the text looked at again, to tell an event of bad fields from
    text that is no event at all.

    ``lost`` names the fields of an event that were lost or changed: the text has a value there of the wrong
    type, or an amount that the decimals of this package do not hold exactly.

    The event passes through a one-element ``explode``: a filter on its fields would otherwise be
    moved below the projection and parse the text again for each field it tests.
    """
    text = F.col("value").cast("string")
    flagged = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = messages.select(
        text.alias("payload"),
        F.explode(
            F.array(F.from_json(text, flagged, {"columnNameOfCorruptRecord": _CORRUPT}))
        ).alias("event"),
    )
    fields = [F.col("event")[field.name] for field in schema.fields]
    suspect = F.col(f"event.{_CORRUPT}").isNotNull() & F.coalesce(
        *[field.cast("string") for field in fields]
    ).isNull()
    malformed = F.when(F.col("event").isNull(), True).when(
        suspect, F.json_object_keys("payload").isNull()
    )
    marked = parsed.withColumn("malformed", F.coalesce(malformed, F.lit(False)))
    lost = F.array_compact(F.array(*[F.when(_lost(field), F.lit(field.name)) for field in schema.fields]))
    return marked.withColumn("lost", F.when(F.col("malformed"), F.array().cast("array<string>")).otherwise(lost))


def _lost(field: T.StructField) -> Column:
    """Whether a field of the event is not what the text has there. The text is looked at again only where
    Spark found some field of the wrong type."""
    value = F.col("event")[field.name]
    in_text = F.get_json_object("payload", f"$['{field.name}']").isNotNull()
    lost = F.when(F.col(f"event.{_CORRUPT}").isNotNull() & value.isNull(), in_text)
    if SNAKE_NAMES.get(field.name) in MONEY_COLUMNS:
        kept = value.try_cast(MONEY).cast("double")
        lost = lost.when(value.isNotNull(), ~kept.eqNullSafe(value.cast("double")))
    return F.coalesce(lost, F.lit(False))


def event_schema(columns: Iterable[str] | None = None) -> T.StructType:
    """The fields of the given columns, by which only these are parsed; all without columns."""
    if columns is None:
        return SALES_EVENT
    wanted = {WIRE_NAMES[name] for name in columns}
    return T.StructType([field for field in SALES_EVENT.fields if field.name in wanted])


def parse_events(messages: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """JSON messages as flat sales events with snake_case names; malformed messages are left out.

    Give the columns that are needed: a field that is not asked for here is parsed all the same if a
    later projection drops it, since the event passes through an ``explode``.
    """
    schema = event_schema(columns)
    return flat_events(parse_payload(messages, schema), schema)


def flat_events(parsed: DataFrame, schema: T.StructType = SALES_EVENT) -> DataFrame:
    """The events of parsed messages, as :func:`parse_events` gives them."""
    events = parsed.where(~F.col("malformed"))
    flat = events.select(*[F.col("event")[field.name].alias(field.name) for field in schema.fields])
    return with_decimal_money(flat.withColumnsRenamed(SNAKE_NAMES))


def rejects(messages: DataFrame, schema: T.StructType = SALES_EVENT) -> DataFrame:
    """The messages that :func:`parse_events` leaves out, as one ``payload`` column."""
    return parse_payload(messages, schema).where("malformed").select("payload")


def losses(parsed: DataFrame) -> DataFrame:
    """Parsed messages of which a field was lost or changed: ``payload`` and the names in ``lost``."""
    return parsed.where(F.size("lost") > 0).select("payload", "lost")


def loss_counts(schema: T.StructType = SALES_EVENT) -> dict[str, Column]:
    """Counters to observe while messages are parsed: all, malformed ones, and those that lost each field."""
    counts = {"messages": F.count(F.lit(1)), "malformed": F.count_if("malformed")}
    return counts | {f.name: F.count_if(F.array_contains("lost", f.name)) for f in schema.fields}


def partly_unreadable(messages: DataFrame, schema: T.StructType = SALES_EVENT) -> DataFrame:
    """Events kept although at least one of their fields was lost or changed, as ``payload``."""
    return losses(parse_payload(messages, schema)).select("payload")


def with_decimal_money(events: DataFrame) -> DataFrame:
    present = set(events.columns)
    money = {
        name: F.col(name).try_cast(MONEY) for name in MONEY_COLUMNS if name in present
    }
    return events.withColumns(money) if money else events


def enrich_events(events: DataFrame) -> DataFrame:
    """Fill the derived columns of raw events that lack them.

    The amount follows from quantity and unit price, the readable date from the epoch seconds, and
    of session duration and session end (epoch seconds) either follows from the other.
    """
    present = set(events.columns)

    def filled(name: str, derived: Column) -> Column:
        return F.coalesce(F.col(name), derived) if name in present else derived

    new: dict[str, Column] = {}
    if {"quantity_sold", "unit_price"} <= present:
        amount = line_amount(F.col("quantity_sold"), F.col("unit_price")).cast(MONEY)
        new["total_sales_amount"] = filled("total_sales_amount", amount)
    if "transaction_date" in present:
        start = F.col("transaction_date")
        new["transaction_date_readable"] = filled("transaction_date_readable", utc_text(start))
        if "session_end_epoch" in present:
            length = session_seconds(start, F.col("session_end_epoch")).cast("string")
            new["session_duration"] = filled("session_duration", length)
        if "session_duration" in present or "session_duration" in new:
            length = new.get("session_duration", F.col("session_duration")).try_cast("bigint")
            new["session_end"] = filled("session_end", session_end(start, length))
    return events.withColumns(new) if new else events
