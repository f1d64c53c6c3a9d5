"""Report history, catalog, preview and the observability operators."""

import json

import pytest
from pyspark.sql import functions as F

from lakeproof.contract import TX_CONTRACT
from lakeproof.operators import observe
from lakeproof.plans.fixtures import AS_OF, tx_raw
from lakeproof.plans.silver import plan_silver
from lakeproof.sources.readers import preview, read_catalog, read_reports, select_report
from lakeproof.sources.writers import write_report

from .conftest import SF_SMALL


CATALOG = {
    "landing": [{"coluna": "order_no", "descricao": "number as delivered"},
                {"coluna": "weight", "descricao": "grams as text"}],
    "checked": [{"coluna": "timestamp", "tipo": "timestamp", "obrigatorio": "Sim", "regras_dq": "not null",
                 "descricao": "when it left"},
                {"coluna": "anomaly", "tipo": "string", "obrigatorio": "Não", "regras_dq": "a known word",
                 "descricao": "what looked odd"}],
}


def _report(spark, variant="clean"):
    p = plan_silver(tx_raw(spark, SF_SMALL, variant), TX_CONTRACT, AS_OF)
    return p.report(p.stats(), AS_OF)


def test_report_history_roundtrip(spark, tmp_path):
    path = str(tmp_path / "reports")
    write_report(_report(spark), path, "20260101_000000_000001")
    write_report(_report(spark, "rejected"), path, "20260102_000000_000001")
    hist = read_reports(spark, path)
    assert [r["batch_id"] for r in hist.collect()] == ["20260102_000000_000001", "20260101_000000_000001"]
    newest = select_report(hist).first()
    assert newest["metrics"]["conformity_rate_pct"] < 80.0
    status = {r["batch_id"]: r["status"] for r in observe.batch_status(hist).collect()}
    assert status == {"20260102_000000_000001": "fail", "20260101_000000_000001": "ok"}


def test_reads_pretty_printed_documents(spark, tmp_path):
    doc = {"execution_date": "2026-01-01T12:00:00", "metrics": {"total_records": 8, "total_errors": 7,
           "conformity_rate_pct": 12.5, "duplicate_records": 0, "unmapped_columns": []},
           "anomalies": {"missing_values": 4, "invalid_values": 4},
           "column_quality": {"amount": {"valid": 6, "null": 1, "invalid": 1, "completeness_pct": 87.5,
                                         "validity_pct": 75.0}},
           "eda": {"categorical": {"location_region": ["Euro", "Asia"]},
                   "numeric": {"amount": {"min": -50.0, "max": 500.0, "avg": 228.64}}}}
    d = tmp_path / "dq_reports"
    d.mkdir()
    (d / "dq_report_20260101_120000.json").write_text(json.dumps(doc, indent=4))
    hist = read_reports(spark, str(d))
    row = hist.first()
    assert row["batch_id"] == "dq_report_20260101_120000"
    # threshold key absent -> dashboard falls back to 95.0
    st = observe.batch_status(hist).first()
    assert st["threshold_pct"] == 95.0 and st["status"] == "fail"
    assert observe.local_time(F.lit(row["execution_date"])) is not None
    lt = hist.select(observe.local_time(F.col("execution_date")).alias("t")).first()["t"]
    assert lt == "01/01/2026 09:00:00"
    drift = {(r["column_name"], r["value"]) for r in observe.document_drift(hist).collect()}
    assert drift == {("location_region", "Euro")}
    v = observe.validity_nonnull(hist).first()
    assert v["validity_nonnull_pct"] == pytest.approx(6 / 7 * 100)


def test_local_time_unparsable_passthrough(spark):
    df = spark.createDataFrame([("not a date",), ("2026-03-01T01:30:00",), ("2024",), ("2024-1-1",), ("2024-05-02",)], "t string")
    out = [r[0] for r in df.select(observe.local_time(F.col("t"))).collect()]
    assert out == ["not a date", "28/02/2026 22:30:00", "2024", "2024-1-1", "01/05/2024 21:00:00"]


def test_bands(spark):
    df = spark.createDataFrame([(80.0,), (79.9,), (75.0,), (74.99,)], "v double")
    out = [r[0] for r in df.selectExpr(observe.band_sql("v", "80.0D")).collect()]
    assert out == ["green", "yellow", "yellow", "red"]


def test_catalog(spark, tmp_path):
    path = tmp_path / "data_catalog.json"
    path.write_text(json.dumps(CATALOG, ensure_ascii=False, indent=4))
    cat = observe.catalog_listing(read_catalog(spark, str(path)))
    rows = cat.collect()
    assert len(rows) == sum(len(v) for v in CATALOG.values())
    layers = [r["layer"] for r in cat.select("layer", "layer_position").distinct()
              .orderBy("layer_position").collect()]
    assert layers == list(CATALOG)
    silver = {r["coluna"]: r["mandatory"] for r in rows if r["layer"] == "checked"}
    assert silver["timestamp"] == "required" and silver["anomaly"] == "optional"
    assert all(r["mandatory"] is None for r in rows if r["layer"] == "landing")


def test_preview(spark, tmp_path):
    path = str(tmp_path / "layer")
    tx_raw(spark, SF_SMALL).write.parquet(path)
    assert preview(spark, path).count() == 250
    assert preview(spark, path, 5000).count() == 1020
    with pytest.raises(FileNotFoundError):
        preview(spark, str(tmp_path / "missing"))


def test_schema_drift_alert(spark):
    row = observe.schema_drift_alert(_report(spark, "drift")).first()
    assert (row["unmapped_count"], row["unmapped_names"], row["drift_alert"]) == (1, "channel", True)


def test_issue_ranking_per_batch(spark):
    rep = _report(spark)
    rows = observe.issue_ranking(rep).orderBy("issue_rank").collect()
    totals = [r["total_issues"] for r in rows]
    assert totals == sorted(totals, reverse=True)
    assert [r["issue_rank"] for r in rows] == list(range(1, 14))


def test_column_ops_over_written_history(spark, tmp_path):
    path = str(tmp_path / "reports")
    write_report(_report(spark), path, "20260101_000000_000001")
    hist = read_reports(spark, path)
    for op in (observe.column_status, observe.issue_ranking, observe.validity_nonnull,
               observe.required_optional, observe.document_drift, observe.numeric_stats,
               observe.kpi_volumes, observe.audit_counts, observe.schema_drift_alert):
        op(hist).write.format("noop").mode("overwrite").save()
    rows = observe.column_status(hist).collect()
    assert len(rows) == 13 and all(r["batch_id"] == "20260101_000000_000001" for r in rows)


def test_report_rewrite_same_batch_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "reports")
    write_report(_report(spark), path, "20260101_000000_000001")
    write_report(_report(spark), path, "20260101_000000_000001")
    assert read_reports(spark, path).count() == 1


def test_report_counts_and_drift_are_complete(spark):
    from lakeproof.operators import quality
    found = spark.range(10_050).selectExpr("'age_group' AS column_name", "CAST(id AS STRING) AS value", "1L AS n")
    profile = found.union(spark.sql("SELECT 'age_group', 'new', 4L"))
    assert quality.categorical_lists(profile, {"age_group": ["new", "veteran"]}) == {"age_group": (["new"], 10_051, 10_050)}
    assert observe.category_drift(profile).count() == observe.profile_drift(profile).count() == 10_050
    rep = plan_silver(tx_raw(spark, SF_SMALL), TX_CONTRACT, AS_OF)
    rep = rep.report(rep.stats(), AS_OF).first()
    assert rep["eda"]["categorical_distinct"]["location_region"] == 6
    assert rep["eda"]["categorical_drifted"]["location_region"] == 1
    assert len(rep["eda"]["categorical"]["location_region"]) == 5


def test_newest_report_over_both_layouts(spark, tmp_path):
    path = tmp_path / "reports"
    write_report(_report(spark), str(path), "20270101_000000_000001")
    (path / "dq_report_20250101_000000.json").write_text("{}")
    assert [r["batch_id"] for r in read_reports(spark, str(path)).collect()] == [
        "20270101_000000_000001", "dq_report_20250101_000000"]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        read_reports(spark, str(tmp_path / "none"))


def test_profile_drift_is_exact(spark, tmp_path):
    from lakeproof.plans.jobs import silver_job
    from lakeproof.sources.paths import LakePaths
    paths = LakePaths(str(tmp_path / "lake"))
    tx_raw(spark, SF_SMALL).write.parquet(paths.bronze)
    res = silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports, as_of=AS_OF,
                     profiles_path=paths.profiles)
    profile = spark.read.parquet(f"{paths.profiles}/batch_id={res.batch_id}")
    drift = {(r["column_name"], r["value"]) for r in observe.profile_drift(profile).collect()}
    assert drift == {("transaction_type", "refund"), ("location_region", "Euro"), ("anomaly", "extreme"),
                     ("age_group", "legacy"), ("purchase_pattern", "bulk")}
    hist = spark.read.parquet(paths.profiles)
    assert {(r["batch_id"], r["column_name"], r["value"]) for r in observe.category_drift(hist).collect()} == {
        (res.batch_id, *d) for d in drift}


def test_missing_report_history(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Nenhum"):
        read_reports(spark, str(tmp_path / "none"))


def test_compacted_history_feeds_the_same_operators(spark, tmp_path):
    from lakeproof.sources.writers import compact_reports
    path, table = str(tmp_path / "reports"), str(tmp_path / "reports_table")
    write_report(_report(spark), path, "20260101_000000_000001")
    write_report(_report(spark, "rejected"), path, "20260102_000000_000001")
    compact_reports(spark, path, table)
    compacted = spark.read.parquet(table)
    a = sorted(observe.batch_status(compacted).collect())
    b = sorted(observe.batch_status(read_reports(spark, path)).collect())
    assert a == b and len(a) == 2
