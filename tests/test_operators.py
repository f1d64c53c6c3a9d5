"""Operator semantics pinned down one by one (casts, dedup, rules, split, quality)."""

import pytest
from pyspark.sql import functions as F

from lakeproof.contract import TX_CONTRACT, Contract, Rule
from lakeproof.functions.casts import lenient_int, lenient_timestamp
from lakeproof.functions.rules import compile_rules
from lakeproof.operators import gold, quality
from lakeproof.operators.shape import (MULTIPLICITY, apply_types, dedup_exact, duplicate_count,
                                       unmapped_columns)
from lakeproof.operators.split import flag, quarantine, valid
from lakeproof.plans.fixtures import AS_OF, tx_raw
from lakeproof.plans.silver import plan_silver

from .conftest import SF_SMALL


def test_lenient_casts_never_raise_under_ansi(spark):
    df = spark.createDataFrame([("3.7",), ("none",), ("1672574400",), ("2024-01-02 03:04:05",), (None,)],
                               "v string")
    out = df.select(lenient_int(F.col("v"), df.schema["v"].dataType).alias("i"),
                    lenient_timestamp(F.col("v"), df.schema["v"].dataType).cast("string").alias("t"),
                    F.col("v").try_cast("float").alias("f")).collect()
    assert [r["i"] for r in out] == [3, None, 1672574400, None, None]
    assert out[2]["t"] == "2023-01-01 12:00:00"
    assert out[3]["t"] == "2024-01-02 03:04:05"
    assert out[1]["t"] is None and out[1]["f"] is None


def test_dedup_normalises_numeric_text(spark):
    df = spark.createDataFrame([("1.0", "x"), ("1.00", "x"), ("1", "x"), ("2", "x"), ("2", "y")],
                               "amount string, transaction_type string")
    counted = dedup_exact(df, TX_CONTRACT, MULTIPLICITY)
    row = duplicate_count(counted).first()
    assert (row["total_incoming"], row["distinct_records"], row["duplicate_records"]) == (5, 3, 2)
    # Without a contract the text is compared as is.
    assert dedup_exact(df).count() == 5


def test_dedup_null_safe_and_float_zero(spark):
    df = spark.createDataFrame([(None, 0.0), (None, -0.0), (float("nan"), 1.0), (float("nan"), 1.0)],
                               "a double, b double")
    assert dedup_exact(df).count() == 2


def test_unmapped_columns_in_table_order():
    class Fake:
        columns = ["z_extra", "amount", "a_extra"]
    assert unmapped_columns(Fake, TX_CONTRACT.expected) == ["z_extra", "a_extra"]


def test_soft_rule_only_when_column_present():
    rules = compile_rules(TX_CONTRACT, ["amount", "risk_score", "timestamp", "transaction_type",
                                        "location_region", "receiving_address", "anomaly"], AS_OF)
    assert list(rules.soft) == ["anomaly"]
    assert rules.categorical == ["transaction_type", "location_region", "anomaly"]


def test_rule_kinds_and_null_semantics(spark):
    contract = Contract(
        name="t", expected=["a", "s"], required=["a"], types={},
        rules=[Rule("a", "between", {"low": 0, "high": 10}, "hard", "bad a"),
               Rule("s", "matches", {"pattern": r"^0x[a-fA-F0-9]+$"}, "soft")])
    df = spark.createDataFrame([(5.0, "0xAB"), (None, None), (11.0, "0x"), (float("nan"), "0XAB")],
                               "a double, s string")
    rules = compile_rules(contract, df.columns)
    stats = quality.batch_stats(flag(df, rules), rules).first()
    assert stats["valid_records"] == 1
    assert stats["n__a__null"] == 1 and stats["n__a__invalid"] == 2  # 11 and NaN
    assert stats["n__s__null"] == 1 and stats["n__s__invalid"] == 2  # bare 0x and upper 0X
    q = quarantine(flag(df, rules), rules).collect()
    assert {r["rejection_reason"] for r in q} == {"bad a"}


def test_split_is_exact_and_reasons_non_empty(spark):
    p = plan_silver(tx_raw(spark, SF_SMALL), TX_CONTRACT, AS_OF)
    total = p.typed().count()
    v, q = p.valid(), p.quarantine()
    assert v.count() + q.count() == total
    assert q.filter((F.col("rejection_reason") == "") | F.col("rejection_reason").isNull()).count() == 0
    assert set(v.columns) == set(p.typed().columns)
    assert q.columns[-1] == "rejection_reason"


def test_quality_invariants(spark):
    p = plan_silver(tx_raw(spark, SF_SMALL), TX_CONTRACT, AS_OF)
    stats = p.stats()
    cq = quality.column_quality(stats, p.rules).collect()
    s = stats.first()
    for r in cq:
        assert r["valid"] + r["null"] + r["invalid"] == s["total_records"]
    m = quality.batch_metrics(stats, p.rules, p.unmapped).first()
    assert m["total_records"] + m["duplicate_records"] == s["total_incoming"] == 1020
    assert (m["total_records"], m["total_errors"]) == (1000, 102)
    assert m["conformity_rate_pct"] == 89.8


def test_empty_batch_report(spark):
    df = tx_raw(spark, SF_SMALL).limit(0)
    p = plan_silver(df, TX_CONTRACT, AS_OF)
    rep = p.report(p.stats(), AS_OF).first()
    assert rep["metrics"]["total_records"] == 0
    assert rep["metrics"]["conformity_rate_pct"] == 0.0
    assert rep["column_quality"]["amount"]["completeness_pct"] == 0.0
    assert rep["eda"]["numeric"]["amount"]["avg"] == 0.0


def test_latest_per_key_variants_agree(spark):
    p = plan_silver(tx_raw(spark, SF_SMALL), TX_CONTRACT, AS_OF)
    sales = gold.sales_only(p.valid())
    a = gold.latest_sale_per_address(sales).select("receiving_address", "amount", "timestamp")
    b = gold.latest_per_key_agg(sales, "receiving_address", ["timestamp", "amount"], ["amount", "timestamp"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_ties_are_deterministic(spark):
    from datetime import datetime
    rows = [("sale", 10.0, datetime(2026, 1, 1), "b"), ("sale", 10.0, datetime(2026, 1, 1), "a"),
            ("sale", 5.0, datetime(2026, 1, 1), "a"), ("sale", 10.0, datetime(2026, 1, 1), "c")]
    df = spark.createDataFrame(rows, "transaction_type string, amount double, timestamp timestamp, "
                                     "receiving_address string")
    top = [r["receiving_address"] for r in gold.top_sales(df, 2).collect()]
    assert top == ["a", "b"]


def test_apply_types_keeps_unknown_columns(spark):
    df = spark.createDataFrame([("1.5", "7", "x")], "amount string, login_frequency string, extra string")
    out = apply_types(df, TX_CONTRACT)
    assert out.columns == ["amount", "login_frequency", "extra"]
    assert dict(out.dtypes) == {"amount": "float", "login_frequency": "int", "extra": "string"}


def test_valid_helper_drops_flag(spark):
    df = spark.createDataFrame([(1,)], "x int")
    rules = compile_rules(Contract("t", ["x"], [], {}, []), df.columns)
    assert valid(flag(df, rules)).columns == ["x"]


@pytest.mark.parametrize("variant,passed", [("clean", True), ("rejected", False)])
def test_breaker_verdict_frame(spark, variant, passed):
    from lakeproof.operators.gates import breaker_verdict
    p = plan_silver(tx_raw(spark, SF_SMALL, variant), TX_CONTRACT, AS_OF)
    v = breaker_verdict(quality.batch_metrics(p.stats(), p.rules)).first()
    assert v["passed"] is passed


def test_dedup_normalises_timestamp_text(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "x"), ("2024-01-01T00:00:00", "x"),
                                ("1704067200", "x"), ("junk", "x"), ("junk", "x")],
                               "timestamp string, transaction_type string")
    row = duplicate_count(dedup_exact(df, TX_CONTRACT, MULTIPLICITY)).first()
    assert (row["distinct_records"], row["duplicate_records"]) == (2, 3)
    typed = apply_types(dedup_exact(df, TX_CONTRACT), TX_CONTRACT)
    assert sorted(str(r[0]) for r in typed.select("timestamp").collect()) == ["2024-01-01 00:00:00", "None"]


def test_rule_literals_are_escaped(spark):
    contract = Contract(
        name="t", expected=["name", "code"], required=[], types={},
        rules=[Rule("name", "in_domain", {"values": ["O'Brien", "back\\slash", "ação"]}, "hard", "it's bad"),
               Rule("code", "matches", {"pattern": r"^\d+\\x'$"}, "soft")])
    df = spark.createDataFrame([("O'Brien", "12\\x'"), ("back\\slash", "12x"), ("ação", None), ("other", "1")],
                               "name string, code string")
    rules = compile_rules(contract, df.columns)
    out = df.selectExpr("*", f"{rules.condition_sql('name')} AS ok_name",
                        f"{rules.condition_sql('code')} AS ok_code").collect()
    assert [r["ok_name"] for r in out] == [True, True, True, False]
    assert [r["ok_code"] for r in out] == [True, False, None, False]
    q = quarantine(flag(df, rules), rules).collect()
    assert [r["rejection_reason"] for r in q] == ["it's bad"]


def test_ip_prefix_text_is_kept_with_declared_text_read(spark, tmp_path):
    # Item 3: inference turns '10.10' into 10.1 and '172' into 172.0; a text read keeps them.
    from lakeproof.sources.readers import read_raw
    path = tmp_path / "ip.csv"
    path.write_text("ip_prefix,amount\n10.10,1\n172,2\n")
    text = apply_types(read_raw(spark, str(path)), TX_CONTRACT)
    assert sorted(r[0] for r in text.select("ip_prefix").collect()) == ["10.10", "172"]
    inferred = apply_types(read_raw(spark, str(path), infer=True), TX_CONTRACT)
    assert sorted(r[0] for r in inferred.select("ip_prefix").collect()) == ["10.1", "172.0"]


def test_percentages_round_half_up(spark):
    # Item 9: 1/800 = 0.125 % -> 0.13 (HALF_UP), zero total -> 0.0.
    from lakeproof.functions.sqltext import pct
    row = spark.range(1).selectExpr(f"{pct('1', '800')} AS a", f"{pct('1', '8')} AS b",
                                    f"{pct('0', '0')} AS c").first()
    assert (row["a"], row["b"], row["c"]) == (0.13, 12.5, 0.0)


def test_regex_anchor_semantics_follow_java(spark):
    # Item 10: '$' matches before a final newline; bare '0x' and upper '0X' fail.
    rules = compile_rules(TX_CONTRACT, TX_CONTRACT.expected, AS_OF)
    df = spark.createDataFrame([("0xAB\n",), ("0x",), ("0XAB",), ("0xab",)], "receiving_address string")
    got = [r[0] for r in df.selectExpr(rules.condition_sql("receiving_address")).collect()]
    assert got == [True, False, False, True]


def test_top_sales_with_a_hot_address_matches_brute_force(spark):
    from pyspark.sql import functions as F2
    p = plan_silver(tx_raw(spark, SF_SMALL), TX_CONTRACT, AS_OF)
    valid_rows = p.valid()
    # One address receives a third of all rows.
    hot = valid_rows.withColumn("receiving_address",
                                F2.when(F2.hash("timestamp", "amount") % 3 == 0, F2.lit("0xHOT"))
                                .otherwise(F2.col("receiving_address")))
    got = [tuple(r) for r in gold.top_sales(hot, 3).collect()]
    got_agg = sorted(tuple(r) for r in gold.latest_per_key_agg(
        gold.sales_only(hot), "receiving_address", ["timestamp", "amount"], ["amount", "timestamp"]).collect())
    pdf = hot.filter("transaction_type = 'sale'").select("receiving_address", "amount", "timestamp").toPandas()
    latest = (pdf.sort_values(["receiving_address", "timestamp", "amount"], ascending=[True, False, False])
              .groupby("receiving_address", as_index=False).head(1))
    want_latest = sorted((r.receiving_address, r.amount, r.timestamp.to_pydatetime())
                         for r in latest.itertuples())
    assert [(a, b, c) for a, b, c in got_agg] == [(a, b, c) for a, b, c in want_latest]
    top = latest.sort_values(["amount", "receiving_address"], ascending=[False, True]).head(3)
    assert got == [(r.receiving_address, r.amount, r.timestamp.to_pydatetime()) for r in top.itertuples()]
