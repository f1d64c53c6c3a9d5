"""Small batches with known answers, through every job."""

from datetime import datetime
from pathlib import Path

import pytest

from lakeproof.contract import TX_CONTRACT
from lakeproof.operators.gates import QualityGateError, circuit_breaker
from lakeproof.plans.jobs import bronze_ingest, gold_region_risk, gold_top_sales, silver_job
from lakeproof.sources.paths import LakePaths
from lakeproof.sources.readers import read_reports


@pytest.mark.parametrize("infer", [False, True])
def test_csv_batch_through_bronze_and_silver(spark, mock_csv, tmp_path, infer):
    paths = LakePaths(str(tmp_path / "lake"), source_csv=mock_csv)
    bronze = bronze_ingest(spark, paths.source, paths.bronze, infer=infer)
    assert bronze.count() == 10 and set(TX_CONTRACT.required) == set(bronze.columns)
    result = silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports)
    good = {r["receiving_address"]: (r["amount"], r["risk_score"]) for r in spark.read.parquet(paths.silver).collect()}
    assert good == {"0x1111aa": (12.25, 33.0), "0x2222bb": (0.0, 0.0), "0x3333cc": (7.5, 100.0)}
    assert result.verdict() == {"conformity_pct": 33.33}
    reasons = {r["receiving_address"]: r["rejection_reason"] for r in spark.read.parquet(paths.quarantine).collect()}
    assert reasons == {
        "0x4444dd": "Erro de Regiao", "0x5555ee": "Erro de Transaction Type",
        "0x6666ff": "Erro de Amount | Erro de Risk Score", "0x7777aa": "Erro de Amount | Erro de Risk Score",
        "0x8888bb": "Erro de Timestamp", "8888bb": "Erro de Receiving Address"}
    report = read_reports(spark, paths.reports).first()
    m, cq = report["metrics"], report["column_quality"]
    assert (m["total_records"], m["total_errors"], m["duplicate_records"], m["error_rate_pct"]) == (9, 6, 1, 66.67)
    assert (report["anomalies"]["missing_values"], report["anomalies"]["invalid_values"]) == (2, 6)
    assert [(cq[c]["invalid"], cq[c]["null"]) for c in ("amount", "risk_score", "timestamp")] == [(1, 1), (1, 1), (1, 0)]


def test_circuit_breaker_blocks_low_conformity():
    with pytest.raises(ValueError, match="Circuit Breaker acionado"):
        circuit_breaker({"conformity_pct": 12.5})


def test_circuit_breaker_threshold_edges():
    assert "aprovada" in circuit_breaker({"conformity_pct": 80.0})
    with pytest.raises(QualityGateError, match="Circuit Breaker acionado"):
        circuit_breaker({"other": 1})  # missing key counts as 0
    with pytest.raises(QualityGateError, match="métricas"):
        circuit_breaker({})
    with pytest.raises(QualityGateError):
        circuit_breaker(None)


def test_gold_tables(spark, tmp_path):
    """A scam above every sale, an address whose last sale is small, and a tie."""
    day = [datetime(2025, 5, d, 9) for d in range(1, 4)]
    rows = [("Asia", "sale", 40.0, 8.0, day[2], "w2"), ("Asia", "sale", 40.0, 9.0, day[0], "w1"),
            ("Africa", "sale", 900.0, 1.0, day[0], "w3"), ("Africa", "sale", 5.0, 2.0, day[1], "w3"),
            ("Europe", "scam", 999.0, 70.0, day[1], "w4"), ("Europe", "sale", 60.0, 31.0, day[1], "w5")]
    silver = str(tmp_path / "silver")
    spark.createDataFrame(rows, "location_region string, transaction_type string, amount double, risk_score double, "
                                "timestamp timestamp_ntz, receiving_address string").write.parquet(silver)
    region = gold_region_risk(spark, silver, str(tmp_path / "region")).collect()
    assert [tuple(r) for r in region] == [("Europe", 50.5), ("Asia", 8.5), ("Africa", 1.5)]
    sales = gold_top_sales(spark, silver, str(tmp_path / "sales")).select("receiving_address", "amount").collect()
    assert [tuple(r) for r in sales] == [("w5", 60.0), ("w1", 40.0), ("w2", 40.0)]


def test_gates(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("timestamp,amount\n")
    with pytest.raises(QualityGateError, match="vazio"):
        bronze_ingest(spark, str(empty), str(tmp_path / "b1"))
    partial = tmp_path / "partial.csv"
    partial.write_text("timestamp,amount\n1672574400,1.0\n")
    with pytest.raises(QualityGateError) as err:
        bronze_ingest(spark, str(partial), str(tmp_path / "b2"))
    msg = str(err.value)
    for c in ["receiving_address", "transaction_type", "location_region", "risk_score"]:
        assert c in msg
    assert "'amount'" not in msg


def test_run_all_stops_gold_when_breaker_trips(spark, mock_csv, tmp_path):
    from lakeproof.plans.jobs import run_all

    paths = LakePaths(str(tmp_path / "lake"), source_csv=mock_csv)
    with pytest.raises(QualityGateError, match="Circuit Breaker acionado"):
        run_all(spark, paths)
    # Silver, quarantine and report are written before the breaker; Gold is not.
    assert spark.read.parquet(paths.silver).count() == 3
    assert read_reports(spark, paths.reports).count() == 1
    import os
    assert not os.path.exists(paths.region_risk)
    assert TX_CONTRACT.threshold_pct == 80.0


def test_silver_job_on_empty_batch(spark, tmp_path):
    from lakeproof.plans.fixtures import AS_OF, tx_raw
    paths = LakePaths(str(tmp_path / "lake"))
    tx_raw(spark, "/root/testdata/sf0.001").limit(0).write.parquet(paths.bronze)
    result = silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports, as_of=AS_OF)
    assert result.verdict() == {"conformity_pct": 0.0}
    rep = read_reports(spark, paths.reports).first()
    assert rep["metrics"]["total_records"] == 0 and rep["eda"]["categorical"]["location_region"] == []
    assert spark.read.parquet(paths.silver).count() == 0


def test_silver_job_leaves_no_scratch_and_few_jobs(spark, mock_csv, tmp_path):
    from lakeproof.session import ensure_checkpoint_dir, sized_shuffle
    paths = LakePaths(str(tmp_path / "lake"), source_csv=mock_csv)
    bronze_ingest(spark, paths.source, paths.bronze)
    spark.sparkContext.setJobGroup("silver-jobs", "")
    result = silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("silver-jobs")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) < 13
    base = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    assert not list(base.glob("lakeproof-scratch/silver-flagged-*"))
    assert result.plan.valid().count() == 3  # the plan still reads Bronze
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffle(spark, 100 * 1024 ** 4):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "204800"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
