"""Referential gate: rows whose key has no partner in another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORPHAN = "orphan_reason"
NO_PARENT, NULL_KEY = "no parent", "null key"
HOT_ROWS, NULL_SALTS = 1_000_000, 1024


def flag_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """``child`` with ``orphan_reason``: null where ``parent`` holds the key.

    The child's keys are counted first (one row per key and map task in the
    shuffle) and only they meet the parent, in an anti-join; so the parent,
    however large, never meets a child row. The keys without a parent are then
    joined back. A key with more than ``hot_rows`` rows is split over as many
    tasks as it has that many rows; there are at most rows / ``hot_rows`` such
    keys, and their list alone is broadcast. Null keys are spread as well.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    known = parent.select(F.col(parent_key or key).alias("__parent"))
    lost = (keys.join(known, F.col("__key") == F.col("__parent"), "left_anti")
            .withColumn("__salts", F.ceil(F.col("__n") / hot_rows).cast("int")))
    hot = lost.where("__salts > 1").select(F.col("__key").alias("__hot"), F.col("__salts").alias("__over"))
    place = F.monotonically_increasing_id()
    salt = F.when(F.col(key).isNull(), F.pmod(place, F.lit(NULL_SALTS))).otherwise(
        F.coalesce(F.pmod(place, F.col("__over")), F.lit(0)))
    salted = (child.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
              .withColumn("__salt", salt.cast("int")).drop("__hot", "__over"))
    split = lost.select("__key", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__at"))
    reason = F.when(F.col(key).isNull(), NULL_KEY).when(F.col("__key").isNotNull(), NO_PARENT)
    return (salted.join(split, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__at")), "left")
            .withColumn(ORPHAN, reason).drop("__key", "__at", "__salt"))


def orphans(flagged: DataFrame) -> DataFrame:
    """The rows for the quarantine, with their reason."""
    return flagged.where(F.col(ORPHAN).isNotNull())


def referenced(flagged: DataFrame) -> DataFrame:
    """The exact complement of ``orphans``, without the reason."""
    return flagged.where(F.col(ORPHAN).isNull()).drop(ORPHAN)
