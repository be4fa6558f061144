"""Uploaded sales tables: CSV with a header and column names that vary."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import quoted

# Names under which an uploaded table may carry each role, first match wins.
ROLE_NAMES = {
    "amount": ("Amount", "Sales", "Revenue"),
    "date": ("Date", "Timestamp"),
    "quantity": ("Qty", "Quantity"),
    "product": ("SKU",),
    "fulfillment": ("fulfilled-by",),
    "courier_status": ("Courier Status",),
    "order_status": ("Status",),
    "currency": ("currency",),
}


#: Holds the whole text of a row that does not fit its header; null for a sound one.
DAMAGED = "_damaged_row"
#: Lines of a header whose names hold line breaks, at most.
_HEADER_LINES = 100


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files at a path, a pattern or below a folder, without hidden ones."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found, waiting = [], list(files.globStatus(where) or [])
    while waiting:
        status = waiting.pop()
        if status.getPath().getName().startswith(("_", ".")) and found:
            continue
        if status.isDirectory():
            waiting += [s for s in files.listStatus(status.getPath()) if s.getPath().getName()[0] not in "_."]
        elif status.getLen():
            found.append(status.getPath().toString())
    return sorted(found)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in a file's first row, from its first lines alone; a name that comes twice gets its place."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    java = spark._jvm.java.io
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    packed = codec.getCodec(where)
    reader = java.BufferedReader(java.InputStreamReader(packed.createInputStream(stream) if packed else stream, "UTF-8"))
    try:
        lines = [reader.readLine() or ""]
        while lines[-1] is not None and "\n".join(lines).count('"') % 2 and len(lines) < _HEADER_LINES:
            lines.append(reader.readLine() or "")
    finally:
        reader.close()
    names = next(csv.reader(io.StringIO("\n".join(lines).removeprefix("\ufeff"))), [])
    seen: dict[str, int] = {}
    for name in names:
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
    return tuple(n if n and seen[n.lower()] == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


def read_sales_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, line_breaks: bool = False
) -> DataFrame:
    """CSV with a header row, from a file, a pattern or all files of a folder.

    Without a schema every column is text: the files are read once, and no value is lost to a type that was
    inferred. Files may have different headers; columns meet by name, whatever their order and case, and files that
    lack one have nulls there. A row that is shorter or longer than the header of its file keeps the values it
    has and is also in the column ``_damaged_row`` as it stands; :func:`damaged_rows` lists such rows. With
    ``line_breaks`` quoted values may hold line breaks, and a file is read by one task instead of several.

    The report turns amounts and quantities into numbers and counts those that are none.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", DAMAGED)
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in _files(spark, path):
        by_header.setdefault(_header(spark, file), []).append(file)
    if not by_header:
        return reader.csv(path)
    parts = []
    for names, files in sorted(by_header.items()):
        fields = [T.StructField(name, T.StringType()) for name in (*names, DAMAGED)]
        parts.append(reader.schema(T.StructType(fields)).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def is_damaged(df: DataFrame) -> Column:
    """Whether a row of an uploaded table did not fit its header; never for tables read otherwise."""
    if DAMAGED not in df.columns:
        return F.lit(False)
    # Spark wants some other column to be read with this one
    other = next(name for name in df.columns if name != DAMAGED)
    return F.when(quoted(DAMAGED).isNull() & quoted(other).isNull(), False).otherwise(quoted(DAMAGED).isNotNull())


def damaged_rows(df: DataFrame) -> DataFrame:
    """The rows that did not fit the header, with what could be read of them."""
    return df.where(is_damaged(df))


def find_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """The column, as spelled in the table, that equals the first candidate found, ignoring case."""
    spelled: dict[str, str] = {}
    for column in columns:
        spelled.setdefault(column.lower(), column)
    matches = (spelled[name.lower()] for name in candidates if name.lower() in spelled)
    return next(matches, None)


def find_roles(columns: Iterable[str]) -> dict[str, str]:
    """The column of each role that the table has."""
    columns = list(columns)
    found = {role: find_column(columns, names) for role, names in ROLE_NAMES.items()}
    return {role: column for role, column in found.items() if column is not None}
