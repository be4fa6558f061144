"""The long format that both reports share.

A report is a frame with one row per figure: ``section`` and ``seq`` give its place, ``metric``,
``key`` and ``value`` the figure, and ``text`` the line to print, null where the figure is part of
another line. Headings and remarks are rows without a metric. A list is as long as its data: no list
is gathered into one string.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "section int, seq int, metric string, key string, value double, text string"
)
HEADING, REMARK, FIGURES = 0, 1, 2


def remarks(spark: SparkSession, lines: Iterable[tuple[int, int, str]]) -> DataFrame:
    """Rows of fixed text, given as (section, seq, text)."""
    rows = [(section, seq, None, None, None, text) for section, seq, text in lines]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def figures(
    df: DataFrame,
    section: int,
    key: Column,
    measures: Sequence[tuple[str, Column]],
    text: Column,
    seq: int | Column = FIGURES,
) -> DataFrame:
    """One row per input row and measure; the first measure carries the text."""
    first = seq if isinstance(seq, Column) else F.lit(seq)
    entries = [
        F.struct(
            (first + place).cast("int").alias("seq"),
            F.lit(name).alias("metric"),
            measure.cast("double").alias("value"),
            (text if place == 0 else F.lit(None)).cast("string").alias("text"),
        )
        for place, (name, measure) in enumerate(measures)
    ]
    listed = df.select(key.cast("string").alias("key"), F.inline(F.array(*entries)))
    return listed.select(
        F.lit(section).cast("int").alias("section"), "seq", "metric", "key", "value", "text"
    )


def joined(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
