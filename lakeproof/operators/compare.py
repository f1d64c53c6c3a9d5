"""What changed between two batches: a multiset difference in one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: the columns, ``n_old``, ``n_new``
    and ``change`` (``added``, ``gone``, ``count``).

    Both batches are counted in one union and one grouped sum, without a join:
    copies collapse in the map tasks, so a row copied a billion times is one
    row per task in the shuffle. Nulls equal nulls, as do NaNs, and 0.0 equals
    -0.0. Columns go by name; batches with other columns are refused.
    """
    apart = sorted(set(old.columns) ^ set(new.columns))
    if apart:
        raise ValueError(f"columns in one batch only: {apart}")
    clash = sorted({"n_old", "n_new", "change"} & set(old.columns))
    if clash:
        raise ValueError(f"columns named like the result's: {clash}")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = old.withColumns({"n_old": one, "n_new": none}).unionByName(new.withColumns({"n_old": none, "n_new": one}))
    counted = both.groupBy(*[F.col(f"`{c}`") for c in old.columns]).agg(
        F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))
    change = F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "gone").otherwise("count")
    return counted.where("n_old <> n_new").withColumn("change", change)


def diff_summary(diff: DataFrame) -> DataFrame:
    """(change, n_rows, n_copies): different rows and copies that changed."""
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum(F.abs(F.col("n_new") - F.col("n_old"))).alias("n_copies"))
