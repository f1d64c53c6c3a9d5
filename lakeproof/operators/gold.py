"""Gold aggregates: grouped average, latest row per key, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(items) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in items]


def avg_by(df: DataFrame, key: str | Sequence[str], value: str, alias: str,
           digits: int = 2, sort_desc: bool = True, rank_col: str | None = None) -> DataFrame:
    """Grouped average rounded HALF_UP; optional descending order with the key as tie-breaker.

    ``rank_col`` adds the place in that order, from 1 (a window over the
    groups, of which there is one row each, not over the rows).

    Partial aggregation runs map-side, so a key holding a third of all rows
    still sends one partial row per map task through the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = df.groupBy(*keys).agg(F.round(F.avg(value), digits).alias(alias))
    order = [F.col(alias).desc(), *[F.col(k).asc() for k in keys]]
    if rank_col:
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return out.orderBy(*order) if sort_desc else out


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str],
                   rank_col: str = "__rn") -> DataFrame:
    """First row per key under ``order`` (e.g. newest timestamp, then largest amount).

    Expressed as ``row_number() = 1``; Catalyst plans it as a WindowGroupLimit
    before and after the shuffle, so every map task forwards at most one row
    per key and a hot key cannot flood a single reducer.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def latest_per_key_agg(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                       carry: Sequence[str]) -> DataFrame:
    """Same result as ``latest_per_key`` through an aggregate: ``max_by`` over a struct.

    ``order`` lists columns compared descending, lexicographically; ``carry``
    are the columns returned from the winning row. Map-side combine applies.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in carry])
    best = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in carry])


def top_k(df: DataFrame, order: Sequence[Column | str], k: int,
          columns: Sequence[str] | None = None) -> DataFrame:
    """The first ``k`` rows under ``order``; planned as TakeOrderedAndProject."""
    out = df.orderBy(*_cols(order)).limit(k)
    return out.select(*columns) if columns else out


def region_risk(silver: DataFrame, region: str = "location_region", risk: str = "risk_score",
                rank_col: str | None = None) -> DataFrame:
    """Average risk per region, rounded to 2, highest first."""
    return avg_by(silver, region, risk, "avg_risk_score", rank_col=rank_col)


def sales_only(silver: DataFrame, kind: str = "sale") -> DataFrame:
    return silver.filter(F.col("transaction_type") == F.lit(kind))


def latest_sale_per_address(silver: DataFrame) -> DataFrame:
    """Newest sale per receiving address; ties broken by the larger amount."""
    return latest_per_key(sales_only(silver), "receiving_address",
                          [F.col("timestamp").desc(), F.col("amount").desc()])


def top_sales(silver: DataFrame, k: int = 3) -> DataFrame:
    """The k largest amounts among the newest sale of each receiving address."""
    return top_k(latest_sale_per_address(silver),
                 [F.col("amount").desc(), F.col("receiving_address").asc()], k,
                 ["receiving_address", "amount", "timestamp"])
