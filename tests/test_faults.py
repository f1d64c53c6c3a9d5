"""Dirty input: big integers as text, mixed severities, headers, epochs, zones."""

import time
from datetime import datetime, timedelta, timezone

from lakeproof.contract import Contract, Rule
from lakeproof.functions.casts import lenient_timestamp
from lakeproof.functions.rules import as_of_sql
from lakeproof.plans.silver import plan_silver
from lakeproof.sources.readers import read_raw
from pyspark.sql import functions as F


def _contract(rules, types):
    return Contract(name="t", expected=list(types), required=list(types), types=types, rules=rules)


def test_big_integers_in_text_stay_apart(spark):
    from lakeproof.operators.shape import MULTIPLICITY, apply_types, dedup_exact
    c = _contract([Rule("id", "not_null", {}, "hard", "no id")], {"id": "bigint"})
    df = spark.createDataFrame([("5",), ("5.0",), ("12345678",), ("9007199254740993",), ("9007199254740992",), ("x",)],
                               "id string")
    out = apply_types(dedup_exact(df, c, MULTIPLICITY), c).collect()
    assert {(r["id"], r[MULTIPLICITY]) for r in out} == {
        (5, 2), (12345678, 1), (9007199254740993, 1), (9007199254740992, 1), (None, 1)}


def test_a_soft_rule_does_not_switch_a_hard_one_off(spark):
    c = _contract([Rule("x", "min", {"value": 10}, "soft"), Rule("x", "not_null", {}, "hard", "no x")], {"x": "int"})
    p = plan_silver(spark.createDataFrame([(None,), (5,), (20,)], "x int"), c, "2025-01-01 00:00:00")
    assert {r["x"] for r in p.valid().collect()} == {5, 20}
    assert [r["rejection_reason"] for r in p.quarantine().collect()] == ["no x"]
    from lakeproof.operators import quality
    assert quality.anomaly_totals(p.stats(), p.rules).first()["total_alerts"] == 1


def test_declared_columns_go_by_the_header(spark, tmp_path):
    f = tmp_path / "b.csv"
    f.write_text("amount,ts\n15.5,100\nbad,200\n")
    df = read_raw(spark, str(f), schema="ts bigint, region string, amount double")
    assert "region" not in df.columns
    assert {(r["ts"], r["amount"]) for r in df.collect()} == {(100, 15.5), (200, None)}


def test_fractional_epochs(spark):
    df = spark.sql("SELECT '1672574400.75' AS t, 1672574400.75D AS d")
    got = df.select(lenient_timestamp(F.col("t"), df.schema["t"].dataType).cast("double").alias("t"),
                    lenient_timestamp(F.col("d"), df.schema["d"].dataType).cast("double").alias("d")).first()
    assert (got["t"], got["d"]) == (1672574400.75, 1672574400.75)


def test_now_is_an_instant_in_any_session_zone(spark):
    when = datetime(2025, 1, 1, 12, tzinfo=timezone(timedelta(hours=-3)))
    for zone in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert spark.sql(f"SELECT unix_seconds({as_of_sql(when)}) AS s").first()["s"] == when.timestamp()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_guarded_number_casts_read_odd_texts_as_before(spark):
    texts = ["1700000000", " 1700000000 ", "+5", "-5", "-5.25", "1.", ".5", "1e3", "1E-3", "-1e-3", "1.5d", "2f", "0x1p-3",
             "NaN", "Infinity", "-inf", "inf", "", " ", "-", "x", "1-2", "12:30", "T12:30", "2024", "2024-02", "2024-02-30",
             "2024-02-03", "2024-02-03T04:05:06.789", "2024-02-03 04:05:06+02:00", "9223372036854775807", "9e18", "1\t", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    plain = F.coalesce(t.try_cast("bigint").try_cast("timestamp"), t.try_cast("double").try_cast("timestamp"),
                       t.try_cast("timestamp"))
    got = rows.select("t", lenient_timestamp(t, rows.schema["t"].dataType).cast("string").alias("got"),
                      plain.cast("string").alias("want")).collect()
    assert [(r["t"], r["got"]) for r in got] == [(r["t"], r["want"]) for r in got]
    assert sum(r["want"] is not None for r in got) > 10


def test_times_as_text_cost_no_failed_number_casts(spark):
    rows = spark.range(2_000_000).selectExpr("CAST(timestamp_seconds(1700000000 + id) AS STRING) AS t").persist()
    assert rows.count() == 2_000_000

    def seconds(column):
        def once():
            began = time.perf_counter()
            rows.select(column).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began
        return min(once() for _ in range(3))

    try:
        plain = seconds(F.col("t").try_cast("timestamp"))
        assert seconds(lenient_timestamp(F.col("t"), rows.schema["t"].dataType)) < 4 * plain + 0.2
    finally:
        rows.unpersist()
