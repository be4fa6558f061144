"""Events as keyed JSON messages, and reports as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.schema import WIRE_NAMES


def to_wire(events: DataFrame) -> DataFrame:
    """Events under the field names of the JSON messages; other columns keep their names."""
    return events.withColumnsRenamed(WIRE_NAMES)


def to_kafka_records(df: DataFrame, key_col: str) -> DataFrame:
    """One record per row: the key column as text, and the whole row as JSON with its nulls."""
    row = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return df.select(
        F.col(f"`{key_col}`").cast("string").alias("key"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("value"),
    )


def publish_events(events: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Write events to a topic, keyed by their sales id. Needs the connector of ``fmt``."""
    records = to_kafka_records(to_wire(events), WIRE_NAMES["sales_id"])
    records.write.format(fmt).options(**options).mode("append").save()


def write_report(report: DataFrame, path: str) -> None:
    """The text lines of a report in order.

    A range sort spreads the lines over files whose names follow the order of the lines, so a
    report of any length is written by many tasks; the files one after the other are the report.
    """
    lines = report.where(F.col("text").isNotNull())
    ordered = lines.orderBy("section", "seq", "key", "text")
    ordered.select("text").write.mode("overwrite").text(path)
