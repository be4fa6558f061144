"""Column expressions shared by the metrics, the ingest and the reports.

All of them are built-in expressions, so they stay inside whole-stage code generation. Times are
UTC whatever the session time zone: they go through TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schema import MONEY

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# Names and limits of the age bands.
def age_group(age: Column) -> Column:
    """Age band; a missing age and an age below 18 are both "Unknown"."""
    return (
        F.when(age.between(18, 35), "Young Age")
        .when(age.between(36, 60), "Middle Age")
        .when(age > 60, "Old Age")
        .otherwise("Unknown")
    )


def utc_text(epoch_seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    moment = F.expr(_EPOCH) + F.make_dt_interval(secs=epoch_seconds)
    return moment.cast("string")


def epoch_of(moment: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ that holds UTC."""
    elapsed = (moment - F.expr(_EPOCH)).cast(T.DayTimeIntervalType(3, 3))
    return F.floor(elapsed.cast("decimal(20,6)")).cast("bigint")


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Quantity times unit price, to the cent, in decimal arithmetic."""
    return F.round(quantity.cast("decimal(18,0)") * unit_price.cast("decimal(18,2)"), 2)


def session_end(start_epoch: Column, duration_seconds: Column) -> Column:
    """Readable end of a session that starts at an epoch second and lasts some seconds."""
    return utc_text(start_epoch + duration_seconds)


def session_seconds(start_epoch: Column, end_epoch: Column) -> Column:
    return end_epoch - start_epoch


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in doubles; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def money_text(amount: Column) -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit("$"), F.format_number(amount.cast("double"), 2))


def percent_text(share: Column) -> Column:
    """A share of one as ``12.34%``; a tie rounds to the even digit, as in :func:`money_text`."""
    percent = F.call_function("format_number", share.cast("double") * 100, F.lit("0.00"))
    return F.concat(percent, F.lit("%"))


def shown(value: Column) -> Column:
    """A value as text; a missing one as None."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def money_shown(amount: Column) -> Column:
    """Money as text; a missing amount as None."""
    return F.coalesce(money_text(amount), F.lit("None"))


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for readers that want no decimals."""
    exact = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: quoted(name).cast("double") for name in exact}) if exact else df


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(df: DataFrame, name: str) -> Column:
    """A column ready to be summed: text is read as a decimal, unreadable text as null, so that a sum does not
    depend on the order of the rows and no text makes it NaN."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return quoted(name).try_cast(MONEY)
    return quoted(name)
