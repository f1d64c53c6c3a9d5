"""Matches and sessions along time, per key, with hot keys split by time.

A window over one key puts all its rows into one task. Here a key's rows are
cut into spans of time; each span is worked on alone, one row per key and span
carries what the later spans need, and the two are put together. Both sides of
that join are dealt by (key, span), and rows of one span need no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN, CARRY = "__span", "__carry"


def _spans(df: DataFrame, time: str, unit: str) -> DataFrame:
    return df.where(F.col(time).isNotNull()).withColumn(SPAN, F.date_trunc(unit, F.col(time)))


def last_before(df: DataFrame, key: str, time: str, tie: str, match: str, carry: list[str], prefix: str,
                unit: str = "day") -> DataFrame:
    """``df`` with the ``carry`` columns (named ``prefix`` + name) of the latest
    earlier row of the same key for which ``match`` (SQL) holds; null where
    there is none. Rows stand in the order of (time, tie); those without a time
    take no part, a null key is a key like any."""
    rows = _spans(df, time, unit)
    found = F.when(F.expr(match), F.struct(*carry))
    within = Window.partitionBy(key, SPAN).orderBy(time, tie).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("__local", F.last(found, ignorenulls=True).over(within))
    latest = rows.groupBy(key, SPAN).agg(F.max_by(found, F.when(F.expr(match), F.struct(time, tie))).alias("__own"))
    before = Window.partitionBy(key).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(F.col(key).alias("__key"), F.col(SPAN).alias("__at"),
                            F.last("__own", ignorenulls=True).over(before).alias(CARRY))
    joined = local.join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col(SPAN) == F.col("__at")), "left")
    best = F.coalesce("__local", CARRY)
    return (joined.withColumns({prefix + c: best[c] for c in carry})
            .drop("__local", CARRY, "__key", "__at", SPAN))


def sessions(df: DataFrame, key: str, time: str, gap_seconds: int, unit: str = "day") -> DataFrame:
    """(key, session_no, session_start, session_end, n_rows): a session ends
    where the key's next row comes more than ``gap_seconds`` later. Numbers
    start at 1. Rows without a time take no part, a null key is a key like any.

    Each span finds its own islands; a span's first island goes on from the
    spans before it if the gap between them is small enough."""
    rows = _spans(df, time, unit)
    within = Window.partitionBy(key, SPAN).orderBy(time)

    def seconds(later, earlier):
        return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1e6

    new = F.coalesce(seconds(F.col(time), F.lag(time).over(within)) > gap_seconds, F.lit(False))
    numbered = (rows.select(key, SPAN, time, new.cast("int").alias("__new"))
                .withColumn("__island", F.sum("__new").over(within.rangeBetween(Window.unboundedPreceding, 0))))
    islands = numbered.groupBy(key, SPAN, "__island").agg(
        F.min(time).alias("__from"), F.max(time).alias("__to"), F.count(F.lit(1)).alias("__n"))
    # from here on one row per island: its number does not grow with a key's rows but with its pauses
    along = Window.partitionBy(key).orderBy("__from")
    starts = F.coalesce(seconds(F.col("__from"), F.lag("__to").over(along)) > gap_seconds, F.lit(True))
    return (islands.withColumn("__starts", starts.cast("int"))
            .withColumn("session_no", F.sum("__starts").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(key, "session_no")
            .agg(F.min("__from").alias("session_start"), F.max("__to").alias("session_end"),
                 F.sum("__n").alias("n_rows")))
