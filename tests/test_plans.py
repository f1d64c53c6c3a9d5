"""Physical-plan properties the engine relies on at scale."""

import contextlib
import io
import re

from lakeproof.contract import TX_CONTRACT
from lakeproof.operators import gold
from lakeproof.plans.fixtures import AS_OF, tx_raw
from lakeproof.plans.silver import plan_silver

from .conftest import SF_SMALL


def _plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def _bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    tx_raw(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_silver_stats_single_data_shuffle(spark, tmp_path):
    p = plan_silver(_bronze(spark, tmp_path), TX_CONTRACT, AS_OF)
    text = _plan_text(p.stats())
    # One hash exchange (the dedup) and one single-partition exchange of partial rows.
    assert len(re.findall(r"hashpartitioning", text)) == 1
    assert len(re.findall(r"SinglePartition", text)) == 1
    # Dedup is pre-aggregated map-side before the shuffle.
    assert "partial_count" in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_valid_and_quarantine_reuse_the_dedup(spark, tmp_path):
    p = plan_silver(_bronze(spark, tmp_path), TX_CONTRACT, AS_OF)
    for df in (p.valid(), p.quarantine()):
        assert len(re.findall(r"hashpartitioning", _plan_text(df))) == 1


def test_top_sales_limits_per_key_before_shuffle(spark, tmp_path):
    silver = _bronze(spark, tmp_path)
    df = gold.top_sales(silver)
    formatted = _plan_text(df)
    assert formatted.count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in formatted
    assert "EqualTo(transaction_type,sale)" in formatted
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", formatted).group(1)
    assert "anomaly" not in read_schema and "ip_prefix" not in read_schema


def test_region_risk_partial_aggregation(spark, tmp_path):
    text = _plan_text(gold.region_risk(_bronze(spark, tmp_path)))
    assert "partial_avg" in text


def test_hot_duplicate_group_collapses_map_side(spark, tmp_path):
    # One row repeated as a third of the batch: the dedup keeps it once and
    # counts every copy.
    base = _bronze(spark, tmp_path)
    hot = base.limit(1)
    for _ in range(9):
        hot = hot.unionByName(hot)
    batch = base.unionByName(hot)
    p = plan_silver(batch, TX_CONTRACT, AS_OF)
    s = p.stats().first()
    assert s["total_incoming"] == 1020 + 512
    assert s["total_records"] == 1000
