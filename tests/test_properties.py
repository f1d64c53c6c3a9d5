"""Invariants of the Silver split and the quality counts on generated batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeproof.contract import TX_CONTRACT
from lakeproof.operators import quality
from lakeproof.plans.silver import plan_silver

_text = st.one_of(st.none(), st.sampled_from(["", "x", "0x", "0xAB", "0XAB", "0xab\n", "10.5", "10", "1.0",
                                              "-3", "NaN", "none", "sale", "Europe", "Euro", "1672574400",
                                              "2024-01-01 00:00:00", "2100-01-01"]))
_row = st.tuples(*([_text] * 6))
_COLS = ["timestamp", "receiving_address", "amount", "transaction_type", "location_region", "risk_score"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_row, min_size=0, max_size=25))
def test_split_and_counts_invariants(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in _COLS))
    p = plan_silver(df, TX_CONTRACT, "2026-01-01 00:00:00")
    stats = p.stats()
    s = stats.first()
    distinct = len(set(rows)) if rows else 0
    assert s["total_incoming"] == len(rows)
    assert s["total_records"] <= distinct
    assert p.valid().count() + p.quarantine().count() == s["total_records"]
    assert p.quarantine().filter("rejection_reason = '' OR rejection_reason IS NULL").count() == 0
    for r in quality.column_quality(stats, p.rules).collect():
        assert r["valid"] + r["null"] + r["invalid"] == s["total_records"]
        assert 0.0 <= r["completeness_pct"] <= 100.0
