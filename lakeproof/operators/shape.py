"""Dedup, schema drift and typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.contract import Contract
from lakeproof.functions.casts import coerce, integer_text_key, numeric_text_key, timestamp_text_key

MULTIPLICITY = "__copies"
_NUMERIC_TYPES = ("float", "double")
_INTEGER_TYPES = ("int", "bigint")
_TIME_TYPES = ("timestamp", "timestamp_ntz")


def _dedup_keys(df: DataFrame, contract: Contract | None) -> DataFrame:
    """Numeric contract columns still held as text get a normalised key.

    With a declared all-string read, '1.0' and '1.00' (or two spellings of
    one instant) would otherwise stay apart although they are the same value.
    """
    if contract is None:
        return df
    fixes = {}
    for name, type_name in contract.types.items():
        if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
            continue
        if type_name in _NUMERIC_TYPES:
            fixes[name] = numeric_text_key(F.col(name))
        elif type_name in _INTEGER_TYPES:
            fixes[name] = integer_text_key(F.col(name))
        elif type_name in _TIME_TYPES:
            fixes[name] = timestamp_text_key(F.col(name))
    return df.withColumns(fixes) if fixes else df


def dedup_exact(df: DataFrame, contract: Contract | None = None,
                count_col: str | None = None) -> DataFrame:
    """Exact-row dedup over all columns, before any cast.

    With ``count_col`` the number of copies of each distinct row is kept, so
    the duplicate count needs no second pass. Both forms aggregate map-side
    first: a row copied a billion times leaves each map task as one row.
    """
    keyed = _dedup_keys(df, contract)
    if count_col is None:
        return keyed.dropDuplicates()
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias(count_col))


def duplicate_count(counted: DataFrame, count_col: str = MULTIPLICITY) -> DataFrame:
    """(total_incoming, distinct_records, duplicate_records) from a counted dedup."""
    return counted.agg(
        F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint").alias("total_incoming"),
        F.count(F.lit(1)).alias("distinct_records"),
    ).withColumn("duplicate_records", F.col("total_incoming") - F.col("distinct_records"))


def unmapped_columns(df: DataFrame, expected) -> list[str]:
    """Columns outside the contract, in table order (schema only, no job)."""
    known = set(expected)
    return [c for c in df.columns if c not in known and c != MULTIPLICITY]


def schema_drift(spark: SparkSession, df: DataFrame, expected) -> DataFrame:
    """Unmapped columns as a table: (column_name, position, data_type)."""
    rows = [(name, pos, df.schema[name].dataType.simpleString())
            for pos, name in enumerate(df.columns) if name in set(unmapped_columns(df, expected))]
    return spark.createDataFrame(rows, "column_name string, position int, data_type string")


def apply_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Coerce every contract column that is present; bad values become NULL."""
    casts = {name: coerce(df, name, type_name)
             for name, type_name in contract.types.items() if name in df.columns}
    return df.withColumns(casts) if casts else df
