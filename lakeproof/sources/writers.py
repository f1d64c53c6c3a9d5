"""Writers: Parquet layers and the append-only report history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full overwrite of a Parquet layer (the job commits atomically per task)."""
    df.write.mode(mode).parquet(path)


def new_batch_id(now: datetime | None = None) -> str:
    """Sortable batch id, ``YYYYmmdd_HHMMSS_ffffff`` in UTC."""
    now = now or datetime.now(timezone.utc)
    return now.strftime("%Y%m%d_%H%M%S_%f")


def write_report(report: DataFrame, path: str, batch_id: str | None = None) -> str:
    """Write one report row as JSON under ``path/batch_id=<id>/``; returns the id.

    Each batch owns its folder, so the history only grows by new batches and
    a retried batch replaces its own report instead of adding a second row.
    """
    batch_id = batch_id or new_batch_id()
    report.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/batch_id={batch_id}")
    return batch_id


def compact_reports(spark, reports_path: str, table_path: str) -> None:
    """Fold the per-batch JSON reports into one Parquet table (one row per batch).

    Long histories otherwise mean one small file per batch to list and parse;
    the observability operators accept the compacted table as it is.
    """
    from lakeproof.sources.readers import read_reports

    read_reports(spark, reports_path).write.mode("overwrite").parquet(table_path)
