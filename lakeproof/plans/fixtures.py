"""Transaction batches derived from the ``events`` test table.

The test tables are read-only and hold no faults, so the batch used by the
registered queries is derived from ``events`` with injected faults: NULLs,
out-of-domain values, future timestamps, negative amounts, bad addresses and
exact duplicate rows. Every event row is kept; the modulo tests only decide
which rows carry a fault, and duplicates are added, never removed.

The same SQL text runs in Spark (``spark.sql`` with the events frame bound as
a parameter) and in DuckDB (the oracle), so both sides read identical input.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2026-01-01 00:00:00"

_TX_RAW_TEMPLATE = """
WITH base AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 211 = 0 THEN CAST('2100-01-01 00:00:00' AS @NTZ@) ELSE ts END AS timestamp,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'unknown' ELSE '0x' || hex(user_id + 4096) END AS sending_address,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN '0xZZ' ELSE '0x' || hex(user_id + 256) END AS receiving_address,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN -value ELSE value END AS amount,
    CASE WHEN event_id % 149 = 0 THEN NULL WHEN event_id % 151 = 0 THEN 'refund'
         WHEN event_type = 'purchase' THEN 'sale' WHEN event_type = 'view' THEN 'purchase'
         WHEN event_type = 'click' THEN 'transfer' WHEN event_type = 'signup' THEN 'phishing' ELSE 'scam' END AS transaction_type,
    CASE WHEN event_id % 131 = 0 THEN NULL WHEN event_id % 137 = 0 THEN 'Euro'
         WHEN user_id % 5 = 0 THEN 'Europe' WHEN user_id % 5 = 1 THEN 'South America' WHEN user_id % 5 = 2 THEN 'Asia'
         WHEN user_id % 5 = 3 THEN 'Africa' ELSE 'North America' END AS location_region,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '10'
         ELSE CAST(10 + user_id % 200 AS STRING) || '.' || CAST(event_id % 256 AS STRING) END AS ip_prefix,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS login_frequency,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id % 120 AS INT) END AS session_duration,
    CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 47 = 0 THEN 'bulk' WHEN event_id % 3 = 0 THEN 'focused'
         WHEN event_id % 3 = 1 THEN 'high_value' ELSE 'random' END AS purchase_pattern,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'legacy' WHEN user_id % 3 = 0 THEN 'established'
         WHEN user_id % 3 = 1 THEN 'veteran' ELSE 'new' END AS age_group,
    CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 113 = 0 THEN CAST(105 AS DOUBLE)
         ELSE CAST((event_id * 7) % 401 AS DOUBLE) / 4 END AS risk_score,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'extreme' WHEN (event_id * 7) % 401 < 134 THEN 'low_risk'
         WHEN (event_id * 7) % 401 < 267 THEN 'moderate_risk' ELSE 'high_risk' END AS anomaly
    @EXTRA@
  FROM @EVENTS@
), dup AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE id % 50 = 0)
SELECT timestamp, sending_address, receiving_address, amount, transaction_type, location_region, ip_prefix,
       login_frequency, session_duration, purchase_pattern, age_group, risk_score, anomaly @EXTRA_OUT@
FROM dup
"""

# A rejected batch: a quarter of the amounts are missing, so conformity is at most 75%.
_REJECTED_AMOUNT = "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN -value ELSE value END AS amount"
_NORMAL_AMOUNT = "CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN -value ELSE value END AS amount"


def tx_raw_sql(dialect: str = "spark", variant: str = "clean", events: str | None = None) -> str:
    """SQL text of the transaction batch for ``spark`` or ``duckdb``.

    variant: ``clean`` (the base batch), ``rejected`` (fails the breaker),
    ``drift`` (adds an uncatalogued ``channel`` column).
    """
    text = _TX_RAW_TEMPLATE.replace("@NTZ@", "TIMESTAMP_NTZ" if dialect == "spark" else "TIMESTAMP")
    text = text.replace("@EVENTS@", events or ("{events}" if dialect == "spark" else "events"))
    if variant == "rejected":
        text = text.replace(_NORMAL_AMOUNT, _REJECTED_AMOUNT)
    if variant == "drift":
        text = text.replace("@EXTRA@", ", 'web' AS channel").replace("@EXTRA_OUT@", ", channel")
    else:
        text = text.replace("@EXTRA@", "").replace("@EXTRA_OUT@", "")
    return text


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tx_raw(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    """The raw transaction batch (13 columns, typed as in a Parquet Bronze layer)."""
    events = read_table(spark, sf_dir, "events")
    return spark.sql(tx_raw_sql("spark", variant), events=events)


def duckdb_cte(variant: str = "clean", name: str = "tx_raw") -> str:
    """``name AS (...)`` for a DuckDB WITH clause."""
    return f"{name} AS ({tx_raw_sql('duckdb', variant)})"
