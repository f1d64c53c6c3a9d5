"""Ingest gates and the circuit breaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.contract import (CIRCUIT_BREAKER_THRESHOLD_PCT, MSG_BREAKER_PASSED,
                                MSG_BREAKER_TRIPPED, MSG_EMPTY_SOURCE, MSG_MISSING_COLUMNS,
                                MSG_NO_METRICS)
from lakeproof.functions.sqltext import string


class QualityGateError(ValueError):
    """A batch failed a gate; nothing downstream should run."""


def require_non_empty(df: DataFrame) -> DataFrame:
    """Raise when the batch has no rows (a LIMIT 1 job, not a count)."""
    if df.isEmpty():
        raise QualityGateError(MSG_EMPTY_SOURCE)
    return df


def missing_columns(spark: SparkSession, df: DataFrame, required) -> DataFrame:
    """(column_name, present) for every required column (schema only)."""
    present = set(df.columns)
    return spark.createDataFrame([(c, c in present) for c in required],
                                 "column_name string, present boolean")


def filled_counts(df: DataFrame, columns) -> DataFrame:
    """(column_name, n_values): non-null values of each column, 0 where it is
    absent; one partial aggregate over the named columns alone."""
    counts = df.agg(*[(F.count(F.col(c)) if c in df.columns else F.lit(0).cast("bigint")).alias(f"n{i}")
                      for i, c in enumerate(columns)], F.count(F.lit(1)).alias("n_rows"))
    pairs = ", ".join(f"struct({string(c)} AS column_name, n{i} AS n_values)" for i, c in enumerate(columns))
    return counts.selectExpr(f"inline(array({pairs}))")


def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise listing every required column that is absent (case-sensitive)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityGateError(MSG_MISSING_COLUMNS.format(missing=missing))
    return df


def breaker_verdict(metrics: DataFrame, threshold: float = CIRCUIT_BREAKER_THRESHOLD_PCT) -> DataFrame:
    """(conformity_pct, threshold_pct, passed) from a batch-metrics row.

    A missing conformity counts as 0, so it never passes.
    """
    conformity = (F.col("conformity_rate_pct") if "conformity_rate_pct" in metrics.columns
                  else F.lit(None).cast("double"))
    conformity = F.coalesce(conformity, F.lit(0.0))
    return metrics.select(conformity.alias("conformity_pct"),
                          F.lit(float(threshold)).alias("threshold_pct"),
                          (conformity >= F.lit(float(threshold))).alias("passed"))


def circuit_breaker(verdict: dict | None, threshold: float = CIRCUIT_BREAKER_THRESHOLD_PCT) -> str:
    """Raise when conformity is below the threshold; exactly the threshold passes."""
    if not verdict:
        raise QualityGateError(MSG_NO_METRICS)
    conformity = verdict.get("conformity_pct", 0)
    if conformity is None or conformity < threshold:
        raise QualityGateError(MSG_BREAKER_TRIPPED.format(conformity=conformity))
    return MSG_BREAKER_PASSED.format(conformity=conformity)
