"""Observability operators over the report history.

Each function takes a frame of reports (schema ``REPORT_DDL``, one row per
batch, any number of batches) and returns a table; batch identity columns
(``batch_id``, ``execution_date`` when present) are carried through, so the
same operator serves one batch or the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.contract import (CATALOG_OPTIONAL_WORDS, CATALOG_REQUIRED_WORDS,
                                DASHBOARD_FALLBACK_THRESHOLD_PCT, LOCAL_TIME_FORMAT,
                                LOCAL_TIME_OFFSET_HOURS, STATUS_YELLOW_BAND_PCT,
                                TX_DOMAINS, TX_REQUIRED_COLUMNS)
from lakeproof.functions.sqltext import ident, literal, pct, string
from lakeproof.operators.quality import in_domain

_BATCH_KEYS = ("batch_id", "execution_date")
_THRESHOLD = (f"coalesce(metrics.circuit_breaker_threshold_pct, "
              f"{literal(DASHBOARD_FALLBACK_THRESHOLD_PCT)})")


def _keys(reports: DataFrame) -> list[str]:
    return [ident(k) for k in _BATCH_KEYS if k in reports.columns]


def kpi_volumes(reports: DataFrame) -> DataFrame:
    """Ingested = distinct + duplicates; quarantine = errors; clean = distinct - errors."""
    dup = "coalesce(metrics.duplicate_records, 0)"
    ingested = f"(metrics.total_records + {dup})"
    clean = "(metrics.total_records - metrics.total_errors)"
    return reports.selectExpr(
        *_keys(reports),
        f"{ingested} AS total_ingested", f"{dup} AS duplicates",
        "metrics.total_errors AS quarantine", f"{clean} AS clean_records",
        f"{pct(dup, ingested)} AS pct_duplicates",
        f"{pct('metrics.total_errors', ingested)} AS pct_quarantine",
        f"{pct(clean, ingested)} AS pct_clean",
    )


def batch_status(reports: DataFrame) -> DataFrame:
    """Batch passes when conformity reaches the threshold (95.0 when absent)."""
    passed = f"metrics.conformity_rate_pct >= {_THRESHOLD}"
    return reports.selectExpr(*_keys(reports), "metrics.conformity_rate_pct AS conformity_pct",
                              f"{_THRESHOLD} AS threshold_pct", f"{passed} AS passed",
                              f"CASE WHEN {passed} THEN 'ok' ELSE 'fail' END AS status")


def band_sql(value: str, threshold: str, yellow: float = STATUS_YELLOW_BAND_PCT) -> str:
    """green at or above the threshold, yellow within ``yellow`` points below, else red."""
    return (f"CASE WHEN {value} >= {threshold} THEN 'green' "
            f"WHEN {value} >= {threshold} - {literal(float(yellow))} THEN 'yellow' ELSE 'red' END")


def column_rows(reports: DataFrame) -> DataFrame:
    """One row per batch and ruled column, with the batch totals alongside."""
    keys = _keys(reports)
    # Batch-level fields are lifted to top-level columns before the map is
    # unnested: extracting them in the same projection as the generator trips
    # nested-field pruning in Spark 4.1 (attribute not found at execution).
    base = reports.selectExpr(*keys, "metrics.total_records AS total_records",
                              f"{_THRESHOLD} AS threshold_pct", "column_quality")
    rows = base.selectExpr(*keys, "total_records", "threshold_pct", "inline(map_entries(column_quality))")
    return rows.selectExpr(*keys, "total_records", "threshold_pct", "key AS column_name", "value.*")


_VALIDITY_NN = ("CASE WHEN total_records - `null` > 0 "
                "THEN CAST(valid AS DOUBLE) / CAST(total_records - `null` AS DOUBLE) * 100.0D ELSE 100.0D END")


def validity_nonnull(reports: DataFrame) -> DataFrame:
    """Validity over non-null values, unrounded; 100 when a column has no values."""
    return column_rows(reports).selectExpr(*_keys(reports), "column_name",
                                           f"{_VALIDITY_NN} AS validity_nonnull_pct")


def column_status(reports: DataFrame) -> DataFrame:
    """Completeness and non-null validity per column with their three-band status."""
    return column_rows(reports).selectExpr(
        *_keys(reports), "column_name", "completeness_pct", f"{_VALIDITY_NN} AS validity_nonnull_pct",
        f"{band_sql('completeness_pct', 'threshold_pct')} AS completeness_status",
        f"{band_sql(f'({_VALIDITY_NN})', 'threshold_pct')} AS validity_status",
    )


def issue_ranking(reports: DataFrame) -> DataFrame:
    """Columns by invalid + null occurrences, most first (name breaks ties), per batch."""
    keys = _keys(reports)
    if not keys:
        raise ValueError(f"the ranking is per batch: the reports need one of {_BATCH_KEYS}")
    return column_rows(reports).selectExpr(
        *keys, "column_name", "invalid", "`null`", "invalid + `null` AS total_issues",
        f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY invalid + `null` DESC, column_name) AS issue_rank")


def required_optional(reports: DataFrame, required=TX_REQUIRED_COLUMNS) -> DataFrame:
    """Split ruled columns into the required (blocking) and optional groups."""
    names = ", ".join(string(c) for c in required)
    return column_rows(reports).selectExpr(
        *_keys(reports), "column_name",
        f"CASE WHEN column_name IN ({names}) THEN 'required' ELSE 'optional' END AS column_group")


def audit_counts(reports: DataFrame) -> DataFrame:
    """Alerts, missing and invalid occurrences; 0 when absent."""
    return reports.selectExpr(*_keys(reports),
                              "coalesce(metrics.total_alerts, 0) AS alerts",
                              "coalesce(anomalies.missing_values, 0) AS missing_values",
                              "coalesce(anomalies.invalid_values, 0) AS invalid_values")


def schema_drift_alert(reports: DataFrame) -> DataFrame:
    """Number and names of uncatalogued columns, and whether to alert."""
    unmapped = "coalesce(metrics.unmapped_columns, CAST(array() AS ARRAY<STRING>))"
    return reports.selectExpr(*_keys(reports), f"size({unmapped}) AS unmapped_count",
                              f"concat_ws(',', {unmapped}) AS unmapped_names",
                              f"size({unmapped}) > 0 AS drift_alert")


def profile_drift(profile: DataFrame, domains: dict[str, list[str]] = TX_DOMAINS) -> DataFrame:
    """Values found but outside the expected domain, with their counts.

    Reads the categorical profile table, which holds every distinct value of a
    batch; with a ``batch_id`` column the drift is told per batch. A filter
    over a distributed table: no join, no list, no cut.
    """
    keys = [c for c in ("batch_id",) if c in profile.columns]
    return profile.where(f"NOT {in_domain(domains)}").selectExpr(*keys, "column_name", "value", "n")


def category_drift(profile: DataFrame, domains: dict[str, list[str]] = TX_DOMAINS) -> DataFrame:
    """The drifted values alone, per column (and batch)."""
    return profile_drift(profile, domains).drop("n")


def document_drift(reports: DataFrame, domains: dict[str, list[str]] = TX_DOMAINS) -> DataFrame:
    """Drifted values listed in report documents of the plain layout, which
    hold every value found. The engine's own reports list domain values only;
    their drift is in the profile table."""
    return reports.selectExpr(*_keys(reports), "explode(eda.categorical) AS (column_name, found)").selectExpr(
        *_keys(reports), "column_name", "explode(found) AS value").where(f"NOT {in_domain(domains)}")


def numeric_stats(reports: DataFrame) -> DataFrame:
    """(column_name, min, max, avg) from the report's numeric profile."""
    keys = _keys(reports)
    return (reports.selectExpr(*keys, "explode(eda.numeric) AS (column_name, s)")
            .selectExpr(*keys, "column_name", "s.min", "s.max", "s.avg"))


def local_time(text: Column, hours: int = LOCAL_TIME_OFFSET_HOURS, fmt: str = LOCAL_TIME_FORMAT) -> Column:
    """A whole ISO date, with or without a time, moved by ``hours``; any other
    text (a year or a month alone, say) as it is."""
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}.*)?$"), text.try_cast("timestamp_ntz"))
    return F.coalesce(F.date_format(F.timestamp_add("HOUR", F.lit(hours), parsed), fmt), text)


def catalog_listing(catalog: DataFrame) -> DataFrame:
    """Catalog rows with the mandatory flag classified (only layers having the field)."""
    req = ", ".join(string(w) for w in CATALOG_REQUIRED_WORDS)
    opt = ", ".join(string(w) for w in CATALOG_OPTIONAL_WORDS)
    flag = "lower(trim(obrigatorio))"
    return catalog.selectExpr(
        "*", f"CASE WHEN {flag} IN ({req}) THEN 'required' WHEN {flag} IN ({opt}) THEN 'optional' END AS mandatory")
