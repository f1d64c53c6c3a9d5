"""Lenient coercions that stay JVM-side under ANSI mode.

A dirty cell becomes NULL (and then fails its not-null rule) instead of
failing the job, as casts behaved before ANSI mode became the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def lenient_float(c: Column) -> Column:
    return c.try_cast("float")


def lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def lenient_int(c: Column, source: T.DataType | None = None) -> Column:
    """Integer coercion that truncates '3.7' to 3 like the legacy cast."""
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.try_cast("int")
    return c.try_cast("double").try_cast("int")


def lenient_bigint(c: Column, source: T.DataType | None = None) -> Column:
    """Whole numbers in any spelling ('1.0', '1e3'), without the loss of a
    double; fractions are cut off as by ``lenient_int``."""
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    return F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,10)").try_cast("bigint"))


def lenient_timestamp(c: Column, source: T.DataType | None = None) -> Column:
    """Epoch seconds or timestamp text to a timestamp; anything else NULL."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    if isinstance(source, _NUMERIC):
        return c.try_cast("timestamp")
    # A failed try_cast of text to a number costs an exception, many times the rest
    # of a row's work, and comes up for every text that is a time. No number has a
    # colon or a dash behind a digit, and no whole one a point.
    whole = F.when(~c.rlike("[0-9]-|[:.]"), c).try_cast("bigint")
    fraction = F.when(~c.rlike("[0-9]-|:"), c).try_cast("double")
    return F.coalesce(whole.try_cast("timestamp"), fraction.try_cast("timestamp"), c.try_cast("timestamp"))


def lenient_string(c: Column) -> Column:
    return c.cast("string")


def coerce(df: DataFrame, column: str, type_name: str) -> Column:
    source = df.schema[column].dataType
    c = F.col(column)
    if type_name == "float":
        return lenient_float(c)
    if type_name == "double":
        return lenient_double(c)
    if type_name == "int":
        return lenient_int(c, source)
    if type_name == "bigint":
        return lenient_bigint(c, source)
    if type_name == "timestamp":
        return lenient_timestamp(c, source)
    if type_name == "timestamp_ntz":
        if isinstance(source, T.TimestampNTZType):
            return c
        return lenient_timestamp(c, source).cast("timestamp_ntz")
    if type_name == "string":
        return lenient_string(c)
    return c.try_cast(type_name)


def numeric_text_key(c: Column) -> Column:
    """Dedup key for a numeric column read as text: '1.0' and '1.00' agree."""
    return F.coalesce(c.try_cast("double").cast("string"), c)


def integer_text_key(c: Column) -> Column:
    """Dedup key for an integer column read as text: whole numbers in their
    plain decimal form, without the loss of a double; other text as it is."""
    number = c.try_cast("decimal(38,10)")
    whole = number.cast("decimal(38,0)")
    return F.coalesce(F.when(number == whole, whole.cast("string")), c)


def timestamp_text_key(c: Column) -> Column:
    """Dedup key for a timestamp column read as text: one spelling per instant,
    in UTC with its offset, so that the two instants of a repeated hour stay
    apart in every session zone. Text that would not parse back stays as it is."""
    instant = lenient_timestamp(c, T.StringType())
    since_epoch = F.unix_micros(instant) * F.expr("INTERVAL '0.000001' SECOND")
    key = F.concat((F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + since_epoch).cast("string"), F.lit("+00:00"))
    return F.when(key.try_cast("timestamp") == instant, key).otherwise(c)
