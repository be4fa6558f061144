"""JSON messages to events, and events to JSON messages."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.schema import EVENT_FIELDS, SALES_EVENT, SNAKE_NAMES
from tallyhouse.sinks.publishing import to_kafka_records, to_wire
from tallyhouse.sources import events


def parsed(spark, *texts):
    messages = spark.createDataFrame([(text,) for text in texts], "value string")
    return events.parse_events(messages)


def test_schema_has_28_fields_with_unique_names():
    assert len(SALES_EVENT) == 28 and len(set(SNAKE_NAMES.values())) == 28


@pytest.mark.parametrize("age", ['"abc"', "3.7", "99999999999"])
def test_bad_field_is_null_and_the_event_stays(spark, age):
    text = f'{{"Age": {age}, "Gender": "male"}}'
    row = parsed(spark, text).first()
    assert row.age is None and row.gender == "male"
    messages = spark.createDataFrame([(text,), ('{"Age": 3}',)], "value string")
    assert [r.payload for r in events.partly_unreadable(messages).collect()] == [text]


def test_event_of_bad_fields_only_is_still_an_event(spark):
    assert parsed(spark, '{"Age": "abc"}', "{}").count() == 2


def test_keys_are_case_sensitive_and_numbers_become_text(spark):
    row = parsed(spark, '{"age": 30, "Sales ID": 1234, "Session Duration": 600, "Extra": 1}').first()
    assert row.age is None
    assert row.sales_id == "1234" and row.session_duration == "600"


def test_money_is_decimal(spark):
    row = parsed(spark, '{"Total Sales Amount": 12.34, "Unit Price": 1e2}').first()
    assert row.total_sales_amount == Decimal("12.3400") and row.unit_price == Decimal("100.0000")


@pytest.mark.parametrize(
    ("amount", "kept", "exact"),
    [
        ("200000000000000", Decimal("200000000000000"), True),
        ("1.23456", Decimal("1.23456"), True),
        ("0.00004", Decimal("0.00004"), True),
        ("0.00000004", Decimal(0), False),
        ("1e30", None, False),
    ],
)
def test_no_amount_is_lost_unseen(spark, amount, kept, exact):
    text = f'{{"Total Sales Amount": {amount}}}'
    assert parsed(spark, text).first().total_sales_amount == kept
    messages = spark.createDataFrame([(text,)], "value string")
    assert events.partly_unreadable(messages).count() == (0 if exact else 1)


def test_text_that_is_no_event_goes_to_the_rejects(spark):
    bad = ["{bad", "", '{"Age": 3', "[]", '"text"', "5", "null"]
    messages = spark.createDataFrame([(t,) for t in [*bad, '{"Age": 3}']] + [(None,)], "value string")
    assert events.parse_events(messages).count() == 1
    assert {r.payload for r in events.rejects(messages).collect()} == {*bad, None}


def test_bytes_are_read_as_text(spark):
    messages = spark.createDataFrame([(bytearray(b'{"Age": 40}'),)], "value binary")
    assert events.parse_events(messages).first().age == 40


def test_published_records_parse_back(spark):
    row = {wire: None for wire, _, _ in EVENT_FIELDS}
    row |= {"Sales ID": "7", "Age": 30, "Total Sales Amount": 1.25, "Transaction Date": 86400}
    event = parsed(spark, json.dumps(row))
    record = to_kafka_records(to_wire(event), "Sales ID").first()
    assert record.key == "7"
    assert json.loads(record.value) == row
    again = parsed(spark, record.value)
    assert again.first() == event.first()


def test_enrichment_fills_what_is_missing(spark):
    raw = spark.createDataFrame(
        [(3, 2.675, 996624000, "600", None), (2, 1.5, 0, None, Decimal("9"))],
        "quantity_sold int, unit_price double, transaction_date bigint, session_duration string,"
        "total_sales_amount decimal(18,4)",
    )
    first, second = events.enrich_events(raw).collect()
    assert first.total_sales_amount == Decimal("8.0400")
    assert first.transaction_date_readable == "2001-08-01 00:00:00"
    assert first.session_end == "2001-08-01 00:10:00"
    assert second.total_sales_amount == Decimal("9.0000") and second.session_end is None


def test_duration_follows_from_the_end_of_the_session(spark):
    raw = spark.createDataFrame([(100, 700)], "transaction_date bigint, session_end_epoch bigint")
    row = events.enrich_events(raw).first()
    assert row.session_duration == "600" and row.session_end == "1970-01-01 00:11:40"


def test_readable_dates_are_utc_in_any_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raw = spark.createDataFrame([(986095801,)], "transaction_date bigint")
        row = events.enrich_events(raw).first()
        assert row.transaction_date_readable == "2001-04-01 03:30:01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_renaming_ignores_case(spark):
    odd = spark.createDataFrame([("Goa",)], "`Location/store` string")
    assert odd.withColumnsRenamed(SNAKE_NAMES).columns == ["location_store"]


def test_each_text_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string").repartition(2)
    counted = events.parse_events(messages).groupBy("gender").agg(F.count("customer_id"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField") == 1 and "Python" not in plan
