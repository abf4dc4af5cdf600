"""Epoch and ISO time conversions. Every timestamp is UTC."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import col

#: Fixed value: an epoch's leading characters that count as seconds.
EPOCH_DIGITS = 10

#: A clock time without a date, which a cast would take for one of today.
CLOCK_ONLY = r"^\s*T?[0-9]{1,2}:"


def epoch_to_utc(value: Column, dtype: T.DataType) -> Column:
    """Epoch seconds or milliseconds to a UTC timestamp.

    The first ten characters are the seconds, whatever follows is a fraction of
    no interest. Null and junk give null. A double goes through a decimal first,
    because its own text form would be scientific.
    """
    if isinstance(dtype, T.IntegralType):
        return F.timestamp_seconds(F.substring(value.cast("string"), 1, EPOCH_DIGITS).try_cast("bigint"))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        value = value.try_cast("decimal(30,6)")
    text = F.substring(value.cast("string"), 1, EPOCH_DIGITS)
    return F.timestamp_seconds(text.try_cast("decimal(16,6)"))


def decode_epochs(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Replace the named epoch columns of ``df`` by UTC timestamps."""
    return df.withColumns({name: epoch_to_utc(col(name), df.schema[name].dataType) for name in names})


def text_time(value: Column) -> Column:
    """ISO text as a UTC timestamp, read whole: fraction and offset count.

    Null and empty texts are null. Any other text that is no time, or a clock
    time without a date, ends the job, so that no reading vanishes from a range
    without a word or moves with the day of the run.
    """
    parsed = F.when(~value.rlike(CLOCK_ONLY), value.try_cast("timestamp"))
    refused = F.raise_error(F.concat(F.lit("not a time: "), value)).cast("timestamp")
    return F.when(F.trim(value) == "", F.lit(None).cast("timestamp")).when(
        value.isNotNull() & parsed.isNull(), refused
    ).otherwise(parsed)


def to_second(value: Column, dtype: T.DataType) -> Column:
    """Reading time at second precision: parsed whole, then truncated.

    Timestamps keep their type.
    """
    if isinstance(dtype, T.StringType):
        return F.date_trunc("second", text_time(value))
    return F.date_trunc("second", value).cast(dtype)


def utc_datetime(moment: datetime | str | float | int) -> datetime:
    """Driver-side moment (datetime, ISO text or epoch seconds) as naive UTC."""
    if isinstance(moment, (int, float)):
        return datetime.fromtimestamp(moment, tz=timezone.utc).replace(tzinfo=None)
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def epoch_seconds(moment: datetime | str | float | int) -> float:
    """Driver-side moment as epoch seconds; a moment without zone is UTC."""
    return utc_datetime(moment).replace(tzinfo=timezone.utc).timestamp()


def utc_literal(moment: datetime | str | float | int, dtype: T.DataType) -> Column:
    """A moment as a literal of the type of the column it is compared with."""
    naive = utc_datetime(moment)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(naive.isoformat(sep=" ") + "+00:00").cast("timestamp")
