"""Registered queries over the test tables, each with its DuckDB oracle.

Every query reads whole tables (``events`` through the derived transaction
batch, or ``lineitem`` / ``orders`` directly) and returns a DataFrame whose
column names match the oracle SQL. The oracle text is written independently
as plain SQL: it restates the semantics, it is not generated by the engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.contract import TX_CONTRACT, TX_REQUIRED_COLUMNS, Contract, Rule
from lakeproof.operators import gold, observe, quality
from lakeproof.operators.compare import batch_diff, diff_summary
from lakeproof.operators.gates import breaker_verdict, filled_counts, missing_columns, require_non_empty
from lakeproof.operators.overlap import overlaps
from lakeproof.operators.refer import flag_orphans, orphans, referenced
from lakeproof.operators.shape import (MULTIPLICITY, apply_types, dedup_exact, duplicate_count,
                                       schema_drift, unmapped_columns)
from lakeproof.operators.split import counts_by_level, reason_counts, rule_flags, split_counts
from lakeproof.operators.temporal import last_before, sessions
from lakeproof.plans.fixtures import AS_OF, duckdb_cte, read_table, tx_raw
from lakeproof.plans.jobs import bronze_ingest, run_all, silver_job
from lakeproof.plans.silver import plan_silver
from lakeproof.session import scratch_path
from lakeproof.sources.paths import LakePaths
from lakeproof.sources.readers import preview, read_layer, read_reports, select_report
from lakeproof.sources.writers import write_layer
from lakeproof.streaming import medallion as streaming

TX_COLS = ["timestamp", "sending_address", "receiving_address", "amount", "transaction_type",
           "location_region", "ip_prefix", "login_frequency", "session_duration",
           "purchase_pattern", "age_group", "risk_score", "anomaly"]


# --------------------------------------------------------------------------- Spark side

def _plan(spark: SparkSession, sf_dir: str, variant: str = "clean"):
    return plan_silver(tx_raw(spark, sf_dir, variant), TX_CONTRACT, AS_OF)


# One written batch of each variant; the ids tell their order in time.
BATCHES = {"clean": "20260101_000000_000000", "rejected": "20260102_000000_000000", "drift": "20260103_000000_000000"}
_LAKES: dict[tuple[str, str, str], LakePaths] = {}


def _lake(spark, sf_dir, variant="clean") -> LakePaths:
    """The layers and report that the Silver job wrote for a variant's batch,
    written once per application and shared by the queries that read them."""
    key = (spark.sparkContext.applicationId, sf_dir, variant)
    if key not in _LAKES:
        paths = LakePaths(scratch_path(spark, f"lake-{variant}"))
        write_layer(tx_raw(spark, sf_dir, variant), paths.bronze)
        silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports, TX_CONTRACT, AS_OF,
                   BATCHES[variant], profiles_path=paths.profiles)
        _LAKES[key] = paths
    return _LAKES[key]


def _report(spark, sf_dir, variant="clean"):
    return select_report(read_reports(spark, _lake(spark, sf_dir, variant).reports), BATCHES[variant])


def _observed(spark, sf_dir, operator, variant="clean"):
    """An observability operator over the written report, without the batch's keys."""
    return operator(_report(spark, sf_dir, variant)).drop("batch_id", "execution_date")


def _profile(spark, sf_dir, variant="clean"):
    return read_layer(spark, f"{_lake(spark, sf_dir, variant).profiles}/batch_id={BATCHES[variant]}")


def _history(spark, sf_dir):
    """The reports of all variants as one history."""
    reports = [read_reports(spark, _lake(spark, sf_dir, v).reports) for v in BATCHES]
    return reduce(DataFrame.unionByName, reports)


def _csv_run(spark, sf_dir) -> LakePaths:
    """A full run from a CSV file of the whole batch, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "csv")
    if key not in _LAKES:
        base = scratch_path(spark, "run-csv")
        paths = LakePaths(f"{base}/lake", source_csv=f"{base}/landing")
        (tx_raw(spark, sf_dir).write.option("header", True)
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(paths.source))
        run_all(spark, paths, TX_CONTRACT, AS_OF)
        _LAKES[key] = paths
    return _LAKES[key]


def q_silver_job_valid(spark, sf_dir):
    return read_layer(spark, _lake(spark, sf_dir).silver)


def q_silver_job_quarantine(spark, sf_dir):
    return read_layer(spark, _lake(spark, sf_dir).quarantine)


def q_report_history(spark, sf_dir):
    """Every batch, newest first by rank, with its status; the newest is selected."""
    history = _history(spark, sf_dir)
    newest = select_report(history).select("batch_id", F.lit(True).alias("selected"))
    ranked = observe.batch_status(history).drop("execution_date").withColumn(
        "newest_rank", F.row_number().over(Window.orderBy(F.col("batch_id").desc())))
    return ranked.join(F.broadcast(newest), "batch_id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def q_run_all_csv(spark, sf_dir):
    """Region risk of a full run from CSV, with the place of each region."""
    order = Window.orderBy(F.col("avg_risk_score").desc(), "location_region")
    return read_layer(spark, _csv_run(spark, sf_dir).region_risk).withColumn("place", F.row_number().over(order))


def q_region_risk_ranked(spark, sf_dir):
    return gold.region_risk(_plan(spark, sf_dir).valid(), rank_col="place")


# Lines as they land, without a header: most are well-formed (some with a quoted comma), others have a field too many or too few.
_EVENT_LINES = """
SELECT CAST(event_id AS STRING) || CASE WHEN event_id % 10 = 0 THEN ',' || CAST(user_id AS STRING) || ',' || event_type || ',more'
         WHEN event_id % 10 = 5 THEN ',' || CAST(user_id AS STRING)
         WHEN event_id % 10 = 7 THEN ',' || CAST(user_id AS STRING) || ',"' || event_type || ', again"'
         ELSE ',' || CAST(user_id AS STRING) || ',' || event_type END AS value FROM {events}
"""
EVENT_LINE_CONTRACT = Contract(name="event_lines", expected=["event_id", "user_id", "event_type"],
                               required=["event_id", "user_id", "event_type"], types={}, rules=[],
                               categorical=[], numeric_profile=[])


def _event_lines(spark, sf_dir) -> str:
    """Bronze and malformed lines of the whole batch, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "lines")
    if key not in _LAKES:
        base = scratch_path(spark, "event-lines")
        spark.sql(_EVENT_LINES, events=read_table(spark, sf_dir, "events")).write.text(f"{base}/landing")
        bronze_ingest(spark, f"{base}/landing", f"{base}/bronze", EVENT_LINE_CONTRACT,
                      malformed_path=f"{base}/malformed", columns=EVENT_LINE_CONTRACT.expected)
        _LAKES[key] = base
    return _LAKES[key]


def q_malformed_rows(spark, sf_dir):
    return read_layer(spark, f"{_event_lines(spark, sf_dir)}/malformed")


def q_well_formed_rows(spark, sf_dir):
    return read_layer(spark, f"{_event_lines(spark, sf_dir)}/bronze")


def q_batch_diff(spark, sf_dir):
    return batch_diff(tx_raw(spark, sf_dir), tx_raw(spark, sf_dir, "rejected"))


def q_batch_diff_summary(spark, sf_dir):
    return diff_summary(q_batch_diff(spark, sf_dir))


def _lineitem_orders(spark, sf_dir):
    """Line items against the orders that are not urgent."""
    orders = read_table(spark, sf_dir, "orders").where("o_orderpriority <> '1-URGENT'")
    return flag_orphans(read_table(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey")


def q_orphan_lineitems(spark, sf_dir):
    return orphans(_lineitem_orders(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_partkey", "orphan_reason")


def q_referenced_lineitems(spark, sf_dir):
    return referenced(_lineitem_orders(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_partkey")


def q_last_view_before_purchase(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    matched = last_before(events, "user_id", "ts", "event_id", "event_type = 'view'", ["event_id", "ts"], "view_")
    return matched.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "view_event_id", "view_ts")


def q_user_sessions(spark, sf_dir):
    return sessions(read_table(spark, sf_dir, "events"), "user_id", "ts", 6 * 3600)


def q_run_all_top_sales(spark, sf_dir):
    return read_layer(spark, _csv_run(spark, sf_dir).top_sales)


# A text batch as it lands: wide and plain ids, junk, missing and negative amounts, second spellings
# of an amount, times as whole and fractional epoch seconds, as ISO text and as junk.
DIRTY_CONTRACT = Contract(
    name="dirty_text", expected=["id", "amount", "at"], required=["id", "amount", "at"],
    types={"id": "bigint", "amount": "double", "at": "timestamp_ntz"},
    rules=[Rule("id", "not_null", {}, "hard", "bad id"), Rule("amount", "min", {"value": 0}, "hard", "bad amount"),
           Rule("at", "not_after", {}, "hard", "bad time")],
    categorical=[], numeric_profile=["amount"])
_DIRTY_TEXT = """
SELECT CASE WHEN event_id % 10 = 0 THEN 'n/a' WHEN event_id % 3 = 0 THEN CAST(9007199254740992 + event_id AS STRING)
            WHEN event_id % 3 = 1 THEN CAST(10000000 + event_id AS STRING) ELSE CAST(event_id AS STRING) END AS id,
       CASE WHEN event_id % 7 = 0 THEN 'junk' WHEN event_id % 7 = 1 THEN NULL
            WHEN event_id % 7 = 2 THEN '-' || CAST(event_id AS STRING) || '.5'
            ELSE CAST(event_id AS STRING) || spelling END AS amount,
       CASE WHEN event_id % 4 = 0 THEN CAST(1672574400 + event_id AS STRING)
            WHEN event_id % 4 = 1 THEN '2023-01-0' || CAST(1 + event_id % 9 AS STRING) || 'T10:00:00'
            WHEN event_id % 4 = 2 THEN CAST(1672574400 + event_id AS STRING) || '.75' ELSE 'soon' END AS at
FROM (SELECT event_id, '.0' AS spelling FROM {events}
      UNION ALL SELECT event_id, '.00' AS spelling FROM {events} WHERE event_id % 50 IN (0, 1))
"""


def _dirty_plan(spark, sf_dir):
    base = scratch_path(spark, "dirty-text")
    spark.sql(_DIRTY_TEXT, events=read_table(spark, sf_dir, "events")).write.option("header", True).csv(f"{base}/landing")
    return plan_silver(bronze_ingest(spark, f"{base}/landing", f"{base}/bronze", DIRTY_CONTRACT), DIRTY_CONTRACT, AS_OF)


def q_dirty_text_typed(spark, sf_dir):
    return _dirty_plan(spark, sf_dir).typed()


def q_dirty_text_quarantine(spark, sf_dir):
    return _dirty_plan(spark, sf_dir).quarantine()


def q_dirty_text_duplicates(spark, sf_dir):
    return duplicate_count(_dirty_plan(spark, sf_dir).flagged)


def q_bigint_ids(spark, sf_dir):
    return _dirty_plan(spark, sf_dir).valid().select("id")


def q_csv_roundtrip_typed(spark, sf_dir):
    base = scratch_path(spark, "csv-roundtrip")
    csv_dir, bronze_dir = f"{base}/raw_csv", f"{base}/bronze"
    (tx_raw(spark, sf_dir).write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(csv_dir))
    bronze = bronze_ingest(spark, csv_dir, bronze_dir, TX_CONTRACT)
    return apply_types(bronze, TX_CONTRACT).select(*TX_COLS)


def q_required_columns(spark, sf_dir):
    """Presence of the required columns, and how many rows fill each."""
    raw = tx_raw(spark, sf_dir)
    return missing_columns(spark, raw, TX_REQUIRED_COLUMNS).join(filled_counts(raw, TX_REQUIRED_COLUMNS), "column_name")


def q_non_empty(spark, sf_dir):
    return require_non_empty(tx_raw(spark, sf_dir)).limit(1).agg((F.count(F.lit(1)) > 0).alias("non_empty"))


def q_dedup_exact(spark, sf_dir):
    return dedup_exact(tx_raw(spark, sf_dir))


def q_duplicate_count(spark, sf_dir):
    return duplicate_count(dedup_exact(tx_raw(spark, sf_dir), TX_CONTRACT, MULTIPLICITY))


def q_schema_drift(spark, sf_dir):
    raw = tx_raw(spark, sf_dir, "drift")
    filled = filled_counts(raw, unmapped_columns(raw, TX_CONTRACT.expected))
    return schema_drift(spark, raw, TX_CONTRACT.expected).select("column_name", "position").join(filled, "column_name")


def q_typed_rows(spark, sf_dir):
    return _plan(spark, sf_dir).typed()


def q_rule_flags(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return rule_flags(p.typed(), p.rules)


# Optional columns that a sparse batch leaves out; their rules don't exist there.
SPARSE = ["purchase_pattern", "age_group", "session_duration"]


def _sparse_plan(spark, sf_dir):
    return plan_silver(tx_raw(spark, sf_dir).drop(*SPARSE), TX_CONTRACT, AS_OF)


def q_rule_flags_sparse(spark, sf_dir):
    p = _sparse_plan(spark, sf_dir)
    return rule_flags(p.typed(), p.rules)


def q_column_quality_sparse(spark, sf_dir):
    p = _sparse_plan(spark, sf_dir)
    return quality.column_quality(p.stats(), p.rules)


def q_valid_rows(spark, sf_dir):
    return _plan(spark, sf_dir).valid()


def q_quarantine_rows(spark, sf_dir):
    return _plan(spark, sf_dir).quarantine()


def q_reason_counts(spark, sf_dir):
    return reason_counts(_plan(spark, sf_dir).quarantine())


def q_split_counts(spark, sf_dir):
    return split_counts(_plan(spark, sf_dir).flagged)


def q_column_quality(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return quality.column_quality(p.stats(), p.rules)


def q_anomaly_totals(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return quality.anomaly_totals(p.stats(), p.rules)


def q_batch_metrics(spark, sf_dir):
    p = _plan(spark, sf_dir)
    m = quality.batch_metrics(p.stats(), p.rules, p.unmapped)
    return m.withColumn("unmapped_count", F.size("unmapped_columns")).drop("unmapped_columns")


def q_categorical_profile(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return quality.categorical_profile(p.typed(), p.rules.categorical)


def q_numeric_profile(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return quality.numeric_profile(p.stats(), p.rules)


def q_dq_report(spark, sf_dir):
    return _report(spark, sf_dir)


def _breaker(spark, sf_dir, variant):
    p = _plan(spark, sf_dir, variant)
    return breaker_verdict(quality.batch_metrics(p.stats(), p.rules, p.unmapped))


def q_circuit_breaker(spark, sf_dir):
    return _breaker(spark, sf_dir, "clean")


def q_circuit_breaker_rejected(spark, sf_dir):
    return _breaker(spark, sf_dir, "rejected")


def q_gold_region_risk(spark, sf_dir):
    return gold.region_risk(_plan(spark, sf_dir).valid())


def q_sales_only(spark, sf_dir):
    return gold.sales_only(_plan(spark, sf_dir).valid())


def q_latest_per_address(spark, sf_dir):
    return gold.latest_sale_per_address(_plan(spark, sf_dir).valid()) \
        .select("receiving_address", "amount", "timestamp")


def q_gold_top_sales(spark, sf_dir):
    return gold.top_sales(_plan(spark, sf_dir).valid())


def q_gold_top_sales_agg(spark, sf_dir):
    latest = gold.latest_per_key_agg(gold.sales_only(_plan(spark, sf_dir).valid()), "receiving_address",
                                     ["timestamp", "amount"], ["amount", "timestamp"])
    return gold.top_k(latest, [F.col("amount").desc(), F.col("receiving_address").asc()], 3,
                      ["receiving_address", "amount", "timestamp"])


def q_kpi_volumes(spark, sf_dir):
    return _observed(spark, sf_dir, observe.kpi_volumes)


def q_batch_status(spark, sf_dir):
    return _observed(spark, sf_dir, observe.batch_status)


def q_column_status(spark, sf_dir):
    return _observed(spark, sf_dir, observe.column_status)


def q_issue_ranking(spark, sf_dir):
    return _observed(spark, sf_dir, observe.issue_ranking)


def q_required_optional(spark, sf_dir):
    return _observed(spark, sf_dir, observe.required_optional)


def q_validity_nonnull(spark, sf_dir):
    return _observed(spark, sf_dir, observe.validity_nonnull)


def q_audit_counts(spark, sf_dir):
    return _observed(spark, sf_dir, observe.audit_counts)


def q_schema_drift_alert(spark, sf_dir):
    return _observed(spark, sf_dir, observe.schema_drift_alert, "drift")


def q_category_drift(spark, sf_dir):
    return observe.category_drift(_profile(spark, sf_dir))


def q_profile_drift(spark, sf_dir):
    return observe.profile_drift(_profile(spark, sf_dir))


def q_user_drift(spark, sf_dir):
    """Drift of a column with very many values: no list, no cut."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("CAST(user_id AS STRING) AS user_id")
    return observe.profile_drift(quality.categorical_profile(users, ["user_id"]), {"user_id": ["1", "2", "3"]})


def q_numeric_stats(spark, sf_dir):
    return _observed(spark, sf_dir, observe.numeric_stats)


def q_report_metrics(spark, sf_dir):
    """The report document's scalar fields, flattened."""
    rep = _report(spark, sf_dir)
    return rep.selectExpr("metrics.total_records", "metrics.total_errors", "metrics.total_alerts",
                          "metrics.duplicate_records", "size(metrics.unmapped_columns) AS unmapped_count",
                          "metrics.error_rate_pct", "metrics.conformity_rate_pct",
                          "metrics.circuit_breaker_threshold_pct",
                          "anomalies.missing_values", "anomalies.invalid_values")


def q_dq_report_json(spark, sf_dir):
    """The whole report document (without its execution time) as JSON text."""
    return _report(spark, sf_dir).selectExpr(
        "to_json(struct(metrics, anomalies, column_quality, eda)) AS report_json")


def q_report_categorical(spark, sf_dir):
    """All values found in the batch, one row per (column, value, position), from the written profile."""
    place = Window.partitionBy("column_name").orderBy("value")
    return _profile(spark, sf_dir).select("column_name", (F.row_number().over(place) - 1).alias("position"), "value")


def q_layer_preview_ordered(spark, sf_dir):
    path = scratch_path(spark, "silver-preview")
    write_layer(_plan(spark, sf_dir).valid(), path)
    return preview(spark, path, 250, order_by=TX_COLS)


def q_local_time(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("ts").cast("string"))
    return ev.select("event_id", observe.local_time(text).alias("local_time"))


def q_layer_preview(spark, sf_dir):
    path = scratch_path(spark, "silver-preview")
    write_layer(_plan(spark, sf_dir).valid(), path)
    return preview(spark, path, 250)


def q_run_all(spark, sf_dir):
    paths = LakePaths(scratch_path(spark, "run-all"))
    result = run_all(spark, paths, TX_CONTRACT, AS_OF, raw=tx_raw(spark, sf_dir))
    return spark.read.parquet(result.paths.region_risk)


# Each order runs a campaign for its customer: some of hours, some of weeks, some of an instant.
_CAMPAIGN_FROM = "o_orderkey * 7919 % 2592000"
_CAMPAIGN_SECONDS = "CASE WHEN o_orderkey % 5 = 0 THEN 1728000 WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 50 * 3600 END"


def q_campaign_sessions(spark, sf_dir):
    """The sessions of each user and the campaigns that ran during them."""
    visits = sessions(read_table(spark, sf_dir, "events"), "user_id", "ts", 6 * 3600).drop("n_rows")
    start = f"TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {_CAMPAIGN_FROM})"
    campaigns = read_table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS user_id", "o_orderkey AS campaign", f"{start} AS campaign_start",
        f"{start} + make_dt_interval(0, 0, 0, {_CAMPAIGN_SECONDS}) AS campaign_end")
    return overlaps(visits, campaigns, "user_id", ("session_start", "session_end"), ("campaign_start", "campaign_end")) \
        .select("user_id", "session_no", "campaign", "overlap_seconds")


def q_quarantine_levels(spark, sf_dir):
    """Rejected rows by reason, region and type at every level, groups of 5 or more."""
    return counts_by_level(_plan(spark, sf_dir).quarantine(), ["rejection_reason", "location_region", "transaction_type"], 5)


# Two deliveries; the second one holds the first again.
STREAM_CUT, STREAM_DELAY_DAYS = "2024-01-16 00:00:00", 3


def _streamed(spark, sf_dir):
    """The tables of a stream that took the batch in two runs and was then started once more."""
    base, landing = scratch_path(spark, "stream"), scratch_path(spark, "stream-landing")
    raw = tx_raw(spark, sf_dir)

    def run():
        streaming.stream_medallion(spark, landing, base, raw.schema, "timestamp", STREAM_DELAY_DAYS * 86_400,
                                   f"{base}/checkpoint", TX_CONTRACT, AS_OF)

    for delivery in (raw.where(F.col("timestamp") < F.lit(STREAM_CUT).cast("timestamp_ntz")), raw):
        delivery.write.mode("append").parquet(landing)
        run()
    run()
    return base


def q_streamed_silver_valid(spark, sf_dir):
    return streaming.read_table(spark, _streamed(spark, sf_dir), "silver").select(*TX_COLS)


def q_streamed_accounts(spark, sf_dir):
    """Where the rows of each micro-batch went."""
    base = _streamed(spark, sf_dir)
    reasons = {"n_late": streaming.LATE, "n_no_time": streaming.NO_TIME, "n_future": streaming.FUTURE}
    aside = streaming.read_table(spark, base, "aside").groupBy("batch_id").agg(
        *[F.count_if(F.col(streaming.REASON) == why).alias(c) for c, why in reasons.items()])
    progress = streaming.read_table(spark, base, "progress", streaming.PROGRESS)
    return progress.join(aside, "batch_id", "left").select(
        "batch_id", "n_in", "n_new", "n_copies", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in reasons])


# A contract for ``lineitem``: the same operators on another table.
LINEITEM_CONTRACT = Contract(
    name="lineitem",
    expected=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    required=["l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate"],
    types={"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
           "l_tax": "double", "l_shipdate": "timestamp_ntz"},
    rules=[
        Rule("l_quantity", "positive", {}, "hard", "bad quantity"),
        Rule("l_extendedprice", "min", {"value": 0}, "hard", "bad price"),
        Rule("l_shipdate", "not_after", {}, "hard", "shipped after cut-off"),
        Rule("l_returnflag", "in_domain", {"values": ["R", "A", "N"]}, "hard", "bad return flag"),
        Rule("l_discount", "between", {"low": 0.0, "high": 0.08}, "soft"),
        Rule("l_linestatus", "in_domain", {"values": ["O"]}, "soft"),
    ],
    categorical=["l_returnflag", "l_linestatus"],
    numeric_profile=["l_quantity", "l_extendedprice"],
)
LINEITEM_AS_OF = "1999-12-31 00:00:00"


def _lineitem_plan(spark, sf_dir):
    return plan_silver(read_table(spark, sf_dir, "lineitem"), LINEITEM_CONTRACT, LINEITEM_AS_OF)


def q_lineitem_column_quality(spark, sf_dir):
    p = _lineitem_plan(spark, sf_dir)
    return quality.column_quality(p.stats(), p.rules)


def q_lineitem_reason_counts(spark, sf_dir):
    return reason_counts(_lineitem_plan(spark, sf_dir).quarantine())


def q_orders_latest_per_customer(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return gold.latest_per_key(orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]) \
        .select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def q_orders_avg_price_by_priority(spark, sf_dir):
    return gold.avg_by(read_table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "avg_totalprice")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "campaign_sessions": q_campaign_sessions,
    "quarantine_levels": q_quarantine_levels,
    "streamed_silver_valid": q_streamed_silver_valid,
    "streamed_accounts": q_streamed_accounts,
    "csv_roundtrip_typed": q_csv_roundtrip_typed,
    "required_columns": q_required_columns,
    "non_empty": q_non_empty,
    "dedup_exact": q_dedup_exact,
    "duplicate_count": q_duplicate_count,
    "schema_drift": q_schema_drift,
    "typed_rows": q_typed_rows,
    "rule_flags": q_rule_flags,
    "rule_flags_sparse": q_rule_flags_sparse,
    "column_quality_sparse": q_column_quality_sparse,
    "valid_rows": q_valid_rows,
    "quarantine_rows": q_quarantine_rows,
    "reason_counts": q_reason_counts,
    "split_counts": q_split_counts,
    "column_quality": q_column_quality,
    "anomaly_totals": q_anomaly_totals,
    "batch_metrics": q_batch_metrics,
    "categorical_profile": q_categorical_profile,
    "numeric_profile": q_numeric_profile,
    "dq_report": q_dq_report,
    "circuit_breaker": q_circuit_breaker,
    "circuit_breaker_rejected": q_circuit_breaker_rejected,
    "gold_region_risk": q_gold_region_risk,
    "sales_only": q_sales_only,
    "latest_per_address": q_latest_per_address,
    "gold_top_sales": q_gold_top_sales,
    "gold_top_sales_agg": q_gold_top_sales_agg,
    "kpi_volumes": q_kpi_volumes,
    "batch_status": q_batch_status,
    "column_status": q_column_status,
    "issue_ranking": q_issue_ranking,
    "required_optional": q_required_optional,
    "validity_nonnull": q_validity_nonnull,
    "audit_counts": q_audit_counts,
    "schema_drift_alert": q_schema_drift_alert,
    "category_drift": q_category_drift,
    "profile_drift": q_profile_drift,
    "user_drift": q_user_drift,
    "numeric_stats": q_numeric_stats,
    "report_metrics": q_report_metrics,
    "dq_report_json": q_dq_report_json,
    "report_categorical": q_report_categorical,
    "layer_preview_ordered": q_layer_preview_ordered,
    "local_time": q_local_time,
    "layer_preview": q_layer_preview,
    "run_all": q_run_all,
    "silver_job_valid": q_silver_job_valid,
    "silver_job_quarantine": q_silver_job_quarantine,
    "report_history": q_report_history,
    "region_risk_ranked": q_region_risk_ranked,
    "malformed_rows": q_malformed_rows,
    "well_formed_rows": q_well_formed_rows,
    "batch_diff": q_batch_diff,
    "batch_diff_summary": q_batch_diff_summary,
    "orphan_lineitems": q_orphan_lineitems,
    "referenced_lineitems": q_referenced_lineitems,
    "last_view_before_purchase": q_last_view_before_purchase,
    "user_sessions": q_user_sessions,
    "run_all_csv": q_run_all_csv,
    "run_all_top_sales": q_run_all_top_sales,
    "dirty_text_typed": q_dirty_text_typed,
    "dirty_text_quarantine": q_dirty_text_quarantine,
    "dirty_text_duplicates": q_dirty_text_duplicates,
    "bigint_ids": q_bigint_ids,
    "lineitem_column_quality": q_lineitem_column_quality,
    "lineitem_reason_counts": q_lineitem_reason_counts,
    "orders_latest_per_customer": q_orders_latest_per_customer,
    "orders_avg_price_by_priority": q_orders_avg_price_by_priority,
}


# --------------------------------------------------------------------------- DuckDB oracles

_COLS = ", ".join(f'"{c}"' for c in TX_COLS)

_TYPED_BODY = """SELECT CAST("timestamp" AS TIMESTAMP) AS "timestamp", sending_address, receiving_address,
         CAST(amount AS FLOAT) AS amount, transaction_type, location_region, CAST(ip_prefix AS VARCHAR) AS ip_prefix,
         CAST(login_frequency AS INTEGER) AS login_frequency, CAST(session_duration AS INTEGER) AS session_duration,
         purchase_pattern, age_group, CAST(risk_score AS FLOAT) AS risk_score, anomaly"""

_FLAGS = """flags AS (
  SELECT *,
    amount IS NOT NULL AND amount >= 0 AS h_amount,
    risk_score IS NOT NULL AND risk_score BETWEEN 0.0 AND 100.0 AS h_risk_score,
    "timestamp" IS NOT NULL AND "timestamp" <= TIMESTAMP '2026-01-01 00:00:00' AS h_timestamp,
    transaction_type IS NOT NULL AND transaction_type IN ('transfer', 'purchase', 'sale', 'phishing', 'scam') AS h_transaction_type,
    location_region IS NOT NULL AND location_region IN ('Europe', 'South America', 'Asia', 'Africa', 'North America') AS h_location_region,
    receiving_address IS NOT NULL AND regexp_matches(receiving_address, '^0x[a-fA-F0-9]+$') AS h_receiving_address,
    anomaly IN ('low_risk', 'moderate_risk', 'high_risk') AS s_anomaly,
    age_group IN ('established', 'veteran', 'new') AS s_age_group,
    purchase_pattern IN ('focused', 'high_value', 'random') AS s_purchase_pattern,
    regexp_matches(ip_prefix, '^\\d{1,3}\\.\\d{1,3}$') AS s_ip_prefix,
    login_frequency > 0 AS s_login_frequency,
    session_duration > 0 AS s_session_duration,
    regexp_matches(sending_address, '^0x[a-fA-F0-9]+$') AS s_sending_address
  FROM typed),
ok_flags AS (
  SELECT *, h_amount AND h_risk_score AND h_timestamp AND h_transaction_type AND h_location_region
            AND h_receiving_address AS ok
  FROM flags)"""

_HARD = ["amount", "risk_score", "timestamp", "transaction_type", "location_region", "receiving_address"]
_SOFT = ["anomaly", "age_group", "purchase_pattern", "ip_prefix", "login_frequency", "session_duration",
         "sending_address"]

_STATS = "stats AS (SELECT count(*) AS total_records, (SELECT count(*) FROM raw) AS total_incoming, " \
         "count(*) FILTER (WHERE ok) AS valid_records, " + ", ".join(
             f'count(*) FILTER (WHERE "{c}" IS NULL) AS {c}_null, '
             f'count(*) FILTER (WHERE "{c}" IS NOT NULL AND NOT {"h" if c in _HARD else "s"}_{c}) AS {c}_invalid'
             for c in _HARD + _SOFT) + " FROM ok_flags)"

_CQ = "cq AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'hard' if c in _HARD else 'soft'}' AS severity, total_records, "
    f'{c}_null AS "null", {c}_invalid AS invalid, total_records - {c}_null - {c}_invalid AS valid FROM stats'
    for c in _HARD + _SOFT) + ")"


def _pct(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN round(({part}) / ({total}) * 100, 2) ELSE 0.0 END"


def _with(*ctes: str, variant: str = "clean") -> str:
    base = [duckdb_cte(variant, "raw"),
            f"typed AS ({_TYPED_BODY} FROM (SELECT DISTINCT * FROM raw))",
            _FLAGS]
    return "WITH " + ",\n".join(base + list(ctes)) + "\n"


_SPARSE_SOFT = ["anomaly", "ip_prefix", "login_frequency", "sending_address"]


def _sparse_with() -> str:
    """The batch without its sparse columns: typed rows and flags of the others."""
    typed = _TYPED_BODY.replace("CAST(session_duration AS INTEGER) AS session_duration,", "") \
        .replace("purchase_pattern, age_group, ", "")
    flags = "\n".join(line for line in _FLAGS.split("\n") if not any(f"AS s_{c}," in line for c in SPARSE))
    return (f"WITH {duckdb_cte('clean', 'raw')}, typed AS ({typed} FROM "
            f"(SELECT DISTINCT * EXCLUDE ({', '.join(SPARSE)}) FROM raw)),\n{flags}\n")


_VALID = f"valid AS (SELECT {_COLS} FROM ok_flags WHERE ok)"
_REASON = "concat_ws(' | ', " + ", ".join(
    f"CASE WHEN NOT h_{c} THEN '{m}' END" for c, m in [
        ("amount", "Erro de Amount"), ("risk_score", "Erro de Risk Score"), ("timestamp", "Erro de Timestamp"),
        ("transaction_type", "Erro de Transaction Type"), ("location_region", "Erro de Regiao"),
        ("receiving_address", "Erro de Receiving Address")]) + ")"
_QUAR = f"quar AS (SELECT {_COLS}, {_REASON} AS rejection_reason FROM ok_flags WHERE NOT ok)"
_METRICS = ("metrics AS (SELECT total_records, total_records - valid_records AS total_errors, "
            + " + ".join(f"{c}_invalid" for c in _SOFT) + " AS total_alerts, "
            "total_incoming - total_records AS duplicate_records, "
            + _pct("total_records - valid_records", "total_records") + " AS error_rate_pct, "
            + _pct("valid_records", "total_records") + " AS conformity_rate_pct, "
            "CAST(80.0 AS DOUBLE) AS circuit_breaker_threshold_pct FROM stats)")
_LATEST = """latest AS (
  SELECT receiving_address, amount, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY receiving_address ORDER BY "timestamp" DESC, amount DESC) AS rn
    FROM valid WHERE transaction_type = 'sale') WHERE rn = 1)"""
_REGION = "SELECT location_region, round(avg(risk_score), 2) AS avg_risk_score FROM valid GROUP BY location_region"
_VALIDITY_NN = ('CASE WHEN total_records - "null" > 0 THEN valid / (total_records - "null") * 100 '
                "ELSE 100.0 END")
_CATEGORICAL = ["transaction_type", "location_region", "anomaly", "age_group", "purchase_pattern"]
_DOMAINS_SQL = {
    "transaction_type": "('transfer', 'purchase', 'sale', 'phishing', 'scam')",
    "location_region": "('Europe', 'South America', 'Asia', 'Africa', 'North America')",
    "anomaly": "('low_risk', 'moderate_risk', 'high_risk')",
    "age_group": "('established', 'veteran', 'new')",
    "purchase_pattern": "('focused', 'high_value', 'random')",
}


def _band(value: str) -> str:
    return (f"CASE WHEN {value} >= 80.0 THEN 'green' WHEN {value} >= 75.0 THEN 'yellow' ELSE 'red' END")


def _numeric_sql() -> str:
    parts = []
    for c in ["amount", "risk_score"]:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"CASE WHEN coalesce(avg({c}), 0) = 0 THEN 0.0 ELSE round(avg({c}), 2) END AS avg FROM typed")
    return " UNION ALL ".join(parts)


_LINEITEM_FLAGS = """li AS (
  SELECT *,
    l_quantity IS NOT NULL AND l_quantity > 0 AS h_l_quantity,
    l_extendedprice IS NOT NULL AND l_extendedprice >= 0 AS h_l_extendedprice,
    l_shipdate IS NOT NULL AND l_shipdate <= TIMESTAMP '1999-12-31 00:00:00' AS h_l_shipdate,
    l_returnflag IS NOT NULL AND l_returnflag IN ('R', 'A', 'N') AS h_l_returnflag,
    l_discount BETWEEN 0.0 AND 0.08 AS s_l_discount,
    l_linestatus IN ('O') AS s_l_linestatus
  FROM (SELECT DISTINCT * FROM lineitem))"""
_LI_HARD = ["l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
_LI_SOFT = ["l_discount", "l_linestatus"]


def _lineitem_cq() -> str:
    stats = "li_stats AS (SELECT count(*) AS total_records, " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_null, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT {'h' if c in _LI_HARD else 's'}_{c}) AS {c}_invalid"
        for c in _LI_HARD + _LI_SOFT) + " FROM li)"
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{'hard' if c in _LI_HARD else 'soft'}' AS severity, "
        f"total_records - {c}_null - {c}_invalid AS valid, {c}_null AS \"null\", {c}_invalid AS invalid, "
        + _pct(f"total_records - {c}_null", "total_records") + " AS completeness_pct, "
        + _pct(f"total_records - {c}_null - {c}_invalid", "total_records") + " AS validity_pct FROM li_stats"
        for c in _LI_HARD + _LI_SOFT)
    return f"WITH {_LINEITEM_FLAGS}, {stats} {body}"


def _lineitem_reasons() -> str:
    reason = "concat_ws(' | ', " + ", ".join(
        f"CASE WHEN NOT h_{c} THEN '{m}' END" for c, m in [
            ("l_quantity", "bad quantity"), ("l_extendedprice", "bad price"),
            ("l_shipdate", "shipped after cut-off"), ("l_returnflag", "bad return flag")]) + ")"
    ok = " AND ".join(f"h_{c}" for c in _LI_HARD)
    return (f"WITH {_LINEITEM_FLAGS} SELECT {reason} AS rejection_reason, count(*) AS n "
            f"FROM li WHERE NOT ({ok}) GROUP BY 1")


def _report_json_sql() -> str:
    """The report document as DuckDB JSON, key order as in the engine's report."""
    def pct(part, total):
        return _pct(part, total)
    t = "s.total_records"
    cq = ", ".join(
        f"'{c}', json_object('valid', {t} - {c}_null - {c}_invalid, 'null', {c}_null, "
        f"'invalid', {c}_invalid, 'completeness_pct', {pct(f'{t} - {c}_null', t)}, "
        f"'validity_pct', {pct(f'{t} - {c}_null - {c}_invalid', t)})"
        for c in _HARD + _SOFT)
    cat = ", ".join(
        f"'{c}', (SELECT coalesce(list_sort(list(DISTINCT CAST({c} AS VARCHAR))), []::VARCHAR[]) FROM typed "
        f"WHERE {c} IN {_DOMAINS_SQL[c]})" for c in _CATEGORICAL)
    cat_d = ", ".join(f"'{c}', (SELECT count(DISTINCT {c}) FROM typed WHERE {c} NOT IN {_DOMAINS_SQL[c]})"
                      for c in _CATEGORICAL)
    cat_n = ", ".join(f"'{c}', (SELECT count(DISTINCT {c}) FROM typed)" for c in _CATEGORICAL)
    num = ", ".join(
        f"'{c}', (SELECT json_object('min', CAST(min({c}) AS DOUBLE), 'max', CAST(max({c}) AS DOUBLE), "
        f"'avg', CASE WHEN coalesce(avg({c}), 0) = 0 THEN 0.0::DOUBLE ELSE round(avg({c}), 2) END) FROM typed)"
        for c in ["amount", "risk_score"])
    missing = " + ".join(f"{c}_null" for c in _HARD + _SOFT)
    invalid = " + ".join(f"{c}_invalid" for c in _HARD + _SOFT)
    return (_with(_STATS, _METRICS)
            + "SELECT CAST(json_object("
              "'metrics', json_object('total_records', m.total_records, 'total_errors', m.total_errors, "
              "'total_alerts', m.total_alerts, 'duplicate_records', m.duplicate_records, "
              "'unmapped_columns', []::VARCHAR[], 'error_rate_pct', m.error_rate_pct, "
              "'conformity_rate_pct', m.conformity_rate_pct, "
              "'circuit_breaker_threshold_pct', m.circuit_breaker_threshold_pct), "
            + f"'anomalies', json_object('missing_values', {missing}, 'invalid_values', {invalid}), "
            + f"'column_quality', json_object({cq}), "
            + f"'eda', json_object('categorical', json_object({cat}), 'numeric', json_object({num}), "
            + f"'categorical_distinct', json_object({cat_n}), 'categorical_drifted', json_object({cat_d}))) AS VARCHAR) "
              "AS report_json "
              "FROM metrics m, stats s")


_DIRTY = """WITH typed AS (SELECT CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 9007199254740992 + event_id
       WHEN event_id % 3 = 1 THEN 10000000 + event_id ELSE event_id END::BIGINT AS id,
  CASE WHEN event_id % 7 IN (0, 1) THEN NULL WHEN event_id % 7 = 2 THEN -(event_id + 0.5) ELSE event_id END::DOUBLE AS amount,
  CASE WHEN event_id % 4 = 0 THEN make_timestamp((1672574400 + event_id) * 1000000)
       WHEN event_id % 4 = 1 THEN TIMESTAMP '2023-01-01 10:00:00' + to_days(CAST(event_id % 9 AS INTEGER))
       WHEN event_id % 4 = 2 THEN make_timestamp((1672574400 + event_id) * 1000000 + 750000) END AS "at" FROM events)
"""
_DIRTY_OK = "id IS NOT NULL AND amount IS NOT NULL AND amount >= 0 AND \"at\" IS NOT NULL"


def _status_sql(variant: str, batch: str) -> str:
    return (f"SELECT '{batch}' AS batch_id, * FROM (" + _with(_STATS, _METRICS, variant=variant)
            + "SELECT conformity_rate_pct AS conformity_pct, threshold AS threshold_pct, conformity_rate_pct >= threshold AS passed, "
              "CASE WHEN conformity_rate_pct >= threshold THEN 'ok' ELSE 'fail' END AS status "
              "FROM (SELECT conformity_rate_pct, circuit_breaker_threshold_pct AS threshold FROM metrics))")


_DIFF_SQL = (f"WITH {duckdb_cte('clean', 'a')}, {duckdb_cte('rejected', 'b')}, diff AS (SELECT {_COLS}, "
             "CAST(count(*) FILTER (WHERE side = 0) AS BIGINT) AS n_old, CAST(count(*) FILTER (WHERE side = 1) AS BIGINT) "
             "AS n_new, CASE WHEN min(side) = 1 THEN 'added' WHEN max(side) = 0 THEN 'gone' ELSE 'count' END AS change "
             "FROM (SELECT *, 0 AS side FROM a UNION ALL SELECT *, 1 AS side FROM b) "
             f"GROUP BY {_COLS} HAVING n_old <> n_new) ")

_SESSIONS_SQL = ("WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END "
                 "AS pause FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), b AS (SELECT *, 1 + sum(pause) "
                 "OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM a) SELECT user_id, CAST(session_no AS "
                 "BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_rows "
                 "FROM b GROUP BY user_id, session_no")

_STREAM_SQL = (f"""WITH {duckdb_cte('clean', 'raw')},
w AS (SELECT max(timestamp) - INTERVAL {STREAM_DELAY_DAYS} DAY AS mark FROM raw WHERE timestamp < TIMESTAMP '{STREAM_CUT}'),
a AS (SELECT count(*) AS n FROM raw WHERE timestamp < TIMESTAMP '{STREAM_CUT}'),
da AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM raw) WHERE timestamp < TIMESTAMP '{STREAM_CUT}'),
db AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM raw) WHERE timestamp >= TIMESTAMP '{STREAM_CUT}'
       AND timestamp <= TIMESTAMP '{AS_OF}'),
b AS (SELECT count(*) AS n, count(*) FILTER (WHERE timestamp < mark) AS late,
             count(*) FILTER (WHERE timestamp IS NULL) AS timeless,
             count(*) FILTER (WHERE timestamp > TIMESTAMP '{AS_OF}') AS future FROM raw, w)
""" + "SELECT CAST(0 AS BIGINT) AS batch_id, a.n AS n_in, da.n AS n_new, a.n - da.n AS n_copies, CAST(0 AS BIGINT) AS n_late, "
      "CAST(0 AS BIGINT) AS n_no_time, CAST(0 AS BIGINT) AS n_future FROM a, da UNION ALL "
      "SELECT 1, b.n, db.n, b.n - late - timeless - future - db.n, late, timeless, future FROM b, db")

ORACLES: dict[str, str] = {
    "campaign_sessions": f"WITH s AS ({_SESSIONS_SQL}), c AS (SELECT o_custkey AS user_id, o_orderkey AS campaign, "
                         f"TIMESTAMP '2024-01-01' + to_seconds({_CAMPAIGN_FROM}) AS b, TIMESTAMP '2024-01-01' "
                         f"+ to_seconds({_CAMPAIGN_FROM}) + to_seconds({_CAMPAIGN_SECONDS}) AS e FROM orders) "
                         "SELECT user_id, session_no, campaign, (epoch_us(least(session_end, e)) - "
                         "epoch_us(greatest(session_start, b))) / 1000000 AS overlap_seconds "
                         "FROM s JOIN c USING (user_id) WHERE session_start <= e AND b <= session_end",
    "quarantine_levels": _with(_QUAR) + "SELECT rejection_reason, location_region, transaction_type, CAST(GROUPING("
                         "rejection_reason, location_region, transaction_type) AS BIGINT) AS level, count(*) AS n_rows "
                         "FROM quar GROUP BY CUBE (rejection_reason, location_region, transaction_type) HAVING n_rows >= 5",
    "streamed_silver_valid": _with(_VALID) + "SELECT * FROM valid",
    "streamed_accounts": _STREAM_SQL,
    "silver_job_valid": _with(_VALID) + "SELECT * FROM valid",
    "silver_job_quarantine": _with(_QUAR) + "SELECT * FROM quar",
    "report_history": "SELECT *, CAST(row_number() OVER (ORDER BY batch_id DESC) AS INTEGER) AS newest_rank, "
                      "batch_id = '20260103_000000_000000' AS selected FROM ("
                      + " UNION ALL ".join(_status_sql(v, b) for v, b in BATCHES.items()) + ")",
    "run_all_csv": _with(_VALID) + "SELECT *, CAST(row_number() OVER (ORDER BY avg_risk_score DESC, location_region) "
                                   f"AS INTEGER) AS place FROM ({_REGION})",
    "run_all_top_sales": _with(_VALID, _LATEST) + "SELECT * FROM latest ORDER BY amount DESC, receiving_address LIMIT 3",
    "dirty_text_typed": _DIRTY + "SELECT * FROM typed",
    "dirty_text_quarantine": _DIRTY + "SELECT *, concat_ws(' | ', CASE WHEN id IS NULL THEN 'bad id' END, "
                                      "CASE WHEN amount IS NULL OR amount < 0 THEN 'bad amount' END, "
                                      "CASE WHEN \"at\" IS NULL THEN 'bad time' END) AS rejection_reason "
                                      f"FROM typed WHERE NOT ({_DIRTY_OK})",
    "dirty_text_duplicates": "SELECT count(*) + count(*) FILTER (WHERE event_id % 50 IN (0, 1)) AS total_incoming, "
                             "count(*) AS distinct_records, count(*) FILTER (WHERE event_id % 50 IN (0, 1)) "
                             "AS duplicate_records FROM events",
    "bigint_ids": _DIRTY + f"SELECT id FROM typed WHERE {_DIRTY_OK}",
    "csv_roundtrip_typed": f"WITH {duckdb_cte('clean', 'raw')} {_TYPED_BODY} FROM raw",
    "required_columns": f"WITH {duckdb_cte('clean', 'raw')} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, true AS present, count(\"{c}\") AS n_values FROM raw"
        for c in ["timestamp", "receiving_address", "amount", "transaction_type", "location_region", "risk_score"]),
    "non_empty": f"WITH {duckdb_cte('clean', 'raw')} SELECT count(*) > 0 AS non_empty FROM raw",
    "dedup_exact": f"WITH {duckdb_cte('clean', 'raw')} SELECT DISTINCT * FROM raw",
    "duplicate_count": f"WITH {duckdb_cte('clean', 'raw')} SELECT count(*) AS total_incoming, "
                       "(SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS distinct_records, "
                       "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicate_records FROM raw",
    "schema_drift": f"WITH {duckdb_cte('drift', 'raw')} SELECT 'channel' AS column_name, 13 AS position, "
                    "count(channel) AS n_values FROM raw",
    "typed_rows": _with() + "SELECT * FROM typed",
    "rule_flags": _with() + f"SELECT {_COLS}, " + ", ".join(
        f"{'h' if c in _HARD else 's'}_{c} AS ok_{c}" for c in _HARD + _SOFT) + " FROM ok_flags",
    "rule_flags_sparse": _sparse_with() + "SELECT " + ", ".join(
        [f'"{c}"' for c in TX_COLS if c not in SPARSE] + [f"h_{c} AS ok_{c}" for c in _HARD]
        + [f"s_{c} AS ok_{c}" for c in _SPARSE_SOFT]) + " FROM ok_flags",
    "column_quality_sparse": _sparse_with() + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS severity, count(*) FILTER (WHERE {flag}) AS valid, "
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "null", '
        f'count(*) FILTER (WHERE "{c}" IS NOT NULL AND NOT {flag}) AS invalid, '
        + _pct(f'count("{c}")', "count(*)") + " AS completeness_pct, "
        + _pct(f"count(*) FILTER (WHERE {flag})", "count(*)") + " AS validity_pct FROM ok_flags"
        for c, kind, flag in [(c, "hard", f"h_{c}") for c in _HARD] + [(c, "soft", f"s_{c}") for c in _SPARSE_SOFT]),
    "valid_rows": _with(_VALID) + "SELECT * FROM valid",
    "quarantine_rows": _with(_QUAR) + "SELECT * FROM quar",
    "reason_counts": _with(_QUAR) + "SELECT rejection_reason, count(*) AS n FROM quar GROUP BY rejection_reason",
    "split_counts": _with() + "SELECT count(*) FILTER (WHERE ok) AS valid_records, "
                              "count(*) FILTER (WHERE NOT ok) AS error_records FROM ok_flags",
    "column_quality": _with(_STATS, _CQ) + 'SELECT column_name, severity, valid, "null", invalid, '
                      + _pct('total_records - "null"', "total_records") + " AS completeness_pct, "
                      + _pct("valid", "total_records") + " AS validity_pct FROM cq",
    "anomaly_totals": _with(_STATS, _CQ) + 'SELECT sum("null")::BIGINT AS missing_values, '
                      "sum(invalid)::BIGINT AS invalid_values, "
                      "sum(invalid) FILTER (WHERE severity = 'soft')::BIGINT AS total_alerts FROM cq",
    "batch_metrics": _with(_STATS, _METRICS) + "SELECT *, 0 AS unmapped_count FROM metrics",
    "categorical_profile": _with() + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM typed "
        f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in _CATEGORICAL),
    "numeric_profile": _with() + _numeric_sql(),
    "circuit_breaker": _with(_STATS, _METRICS) + "SELECT conformity_rate_pct AS conformity_pct, "
                       "CAST(80.0 AS DOUBLE) AS threshold_pct, conformity_rate_pct >= 80.0 AS passed FROM metrics",
    "circuit_breaker_rejected": _with(_STATS, _METRICS, variant="rejected")
                                + "SELECT conformity_rate_pct AS conformity_pct, CAST(80.0 AS DOUBLE) AS threshold_pct, "
                                  "conformity_rate_pct >= 80.0 AS passed FROM metrics",
    "gold_region_risk": _with(_VALID) + _REGION,
    "sales_only": _with(_VALID) + "SELECT * FROM valid WHERE transaction_type = 'sale'",
    "latest_per_address": _with(_VALID, _LATEST) + "SELECT * FROM latest",
    "gold_top_sales": _with(_VALID, _LATEST) + "SELECT * FROM latest ORDER BY amount DESC, receiving_address LIMIT 3",
    "gold_top_sales_agg": _with(_VALID, _LATEST)
                          + "SELECT * FROM latest ORDER BY amount DESC, receiving_address LIMIT 3",
    "kpi_volumes": _with(_STATS, _METRICS)
                   + "SELECT total_records + duplicate_records AS total_ingested, duplicate_records AS duplicates, "
                     "total_errors AS quarantine, total_records - total_errors AS clean_records, "
                   + _pct("duplicate_records", "total_records + duplicate_records") + " AS pct_duplicates, "
                   + _pct("total_errors", "total_records + duplicate_records") + " AS pct_quarantine, "
                   + _pct("total_records - total_errors", "total_records + duplicate_records")
                   + " AS pct_clean FROM metrics",
    "batch_status": _with(_STATS, _METRICS)
                    + "SELECT conformity_rate_pct AS conformity_pct, CAST(80.0 AS DOUBLE) AS threshold_pct, "
                      "conformity_rate_pct >= 80.0 AS passed, "
                      "CASE WHEN conformity_rate_pct >= 80.0 THEN 'ok' ELSE 'fail' END AS status FROM metrics",
    "column_status": _with(_STATS, _CQ)
                     + "SELECT column_name, " + _pct('total_records - "null"', "total_records")
                     + f" AS completeness_pct, {_VALIDITY_NN} AS validity_nonnull_pct, "
                     + _band(_pct('total_records - "null"', "total_records")) + " AS completeness_status, "
                     + _band(_VALIDITY_NN) + " AS validity_status FROM cq",
    "issue_ranking": _with(_STATS, _CQ)
                     + 'SELECT column_name, invalid, "null", invalid + "null" AS total_issues, '
                       'CAST(row_number() OVER (ORDER BY invalid + "null" DESC, column_name) AS INTEGER) AS issue_rank FROM cq',
    "required_optional": _with(_STATS, _CQ)
                         + "SELECT column_name, CASE WHEN column_name IN ('timestamp', 'receiving_address', "
                           "'amount', 'transaction_type', 'location_region', 'risk_score') THEN 'required' "
                           "ELSE 'optional' END AS column_group FROM cq",
    "validity_nonnull": _with(_STATS, _CQ) + f"SELECT column_name, {_VALIDITY_NN} AS validity_nonnull_pct FROM cq",
    "audit_counts": _with(_STATS, _CQ) + 'SELECT sum(invalid) FILTER (WHERE severity = \'soft\')::BIGINT AS alerts, '
                    'sum("null")::BIGINT AS missing_values, sum(invalid)::BIGINT AS invalid_values FROM cq',
    "schema_drift_alert": f"WITH {duckdb_cte('drift', 'raw')} SELECT 1 AS unmapped_count, "
                          "'channel' AS unmapped_names, true AS drift_alert FROM (SELECT count(*) FROM raw)",
    "category_drift": _with() + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM typed "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN {_DOMAINS_SQL[c]}" for c in _CATEGORICAL),
    "profile_drift": _with() + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM typed "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN {_DOMAINS_SQL[c]} GROUP BY {c}" for c in _CATEGORICAL),
    "user_drift": "SELECT 'user_id' AS column_name, CAST(user_id AS VARCHAR) AS value, count(*) AS n FROM events "
                  "WHERE user_id NOT IN (1, 2, 3) GROUP BY user_id",
    "numeric_stats": _with() + _numeric_sql(),
    "local_time": "SELECT event_id, coalesce(strftime(TRY_CAST(txt AS TIMESTAMP) - INTERVAL 3 HOUR, "
                  "'%d/%m/%Y %H:%M:%S'), txt) AS local_time FROM (SELECT event_id, CASE WHEN event_type = 'error' "
                  "THEN props ELSE CAST(ts AS VARCHAR) END AS txt FROM events)",
    "run_all": _with(_VALID) + _REGION,
    "report_metrics": _with(_STATS, _CQ, _METRICS)
                      + "SELECT m.total_records, total_errors, total_alerts, duplicate_records, 0 AS unmapped_count, "
                        "error_rate_pct, conformity_rate_pct, circuit_breaker_threshold_pct, "
                        '(SELECT sum("null") FROM cq)::BIGINT AS missing_values, '
                        "(SELECT sum(invalid) FROM cq)::BIGINT AS invalid_values FROM metrics m",
    "dq_report_json": _report_json_sql(),
    "report_categorical": _with() + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS position, value "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM typed WHERE {c} IS NOT NULL)"
        for c in _CATEGORICAL),
    "region_risk_ranked": _with(_VALID) + "SELECT *, CAST(row_number() OVER (ORDER BY avg_risk_score DESC, "
                          f"location_region) AS INTEGER) AS place FROM ({_REGION})",
    "malformed_rows": "SELECT CASE WHEN event_id % 10 = 0 THEN concat_ws(',', event_id, user_id, event_type, 'more') "
                      "ELSE concat_ws(',', event_id, user_id) END AS raw_line, "
                      "CASE WHEN event_id % 10 = 0 THEN 4 ELSE 2 END AS n_fields, "
                      "CASE WHEN event_id % 10 = 0 THEN 'too many fields' ELSE 'too few fields' END AS reason "
                      "FROM events WHERE event_id % 5 = 0",
    "well_formed_rows": "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
                        "event_type || CASE WHEN event_id % 10 = 7 THEN ', again' ELSE '' END AS event_type "
                        "FROM events WHERE event_id % 5 <> 0",
    "batch_diff": _DIFF_SQL + "SELECT * FROM diff",
    "batch_diff_summary": _DIFF_SQL + "SELECT change, count(*) AS n_rows, CAST(sum(abs(n_new - n_old)) AS BIGINT) "
                          "AS n_copies FROM diff GROUP BY change",
    "orphan_lineitems": "SELECT l_orderkey, l_linenumber, l_partkey, 'no parent' AS orphan_reason FROM lineitem "
                        "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey "
                        "AND o_orderpriority <> '1-URGENT')",
    "referenced_lineitems": "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN "
                            "(SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')",
    "last_view_before_purchase": "SELECT event_id, user_id, ts, v.event_id AS view_event_id, v.ts AS view_ts FROM ("
                                 "SELECT *, max(CASE WHEN event_type = 'view' THEN {'ts': ts, 'event_id': event_id} END) "
                                 "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING "
                                 "AND 1 PRECEDING) AS v FROM events) WHERE event_type = 'purchase'",
    "user_sessions": _SESSIONS_SQL,
    "layer_preview_ordered": _with(_VALID) + f"SELECT * FROM valid ORDER BY " + ", ".join(
        f'"{c}" ASC NULLS FIRST' for c in TX_COLS) + " LIMIT 250",
    "lineitem_column_quality": _lineitem_cq(),
    "lineitem_reason_counts": _lineitem_reasons(),
    "orders_latest_per_customer": "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM ("
                                  "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, "
                                  "o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
    "orders_avg_price_by_priority": "SELECT o_orderpriority, round(avg(o_totalprice), 2) AS avg_totalprice "
                                    "FROM orders GROUP BY o_orderpriority",
}
