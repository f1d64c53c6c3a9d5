"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every case is run once to warm up, then ``$BENCH_REPEAT`` interleaved rounds
(full computation, nothing collected); jobs are timed end to end including
their writes. ``silver_multipass`` runs the same Silver work as
separate actions over an uncached plan of ``dropDuplicates`` and filters, as the self-measured
baseline for ``silver_fused``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))


def _sf_of(path: str) -> str:
    base = os.path.basename(os.path.normpath(path))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    from pyspark.sql import functions as F

    from lakeproof.contract import TX_CONTRACT
    from lakeproof.functions.rules import compile_rules
    from lakeproof.operators import gold, observe, quality
    from lakeproof.operators.shape import apply_types
    from lakeproof.plans import queries as Q
    from lakeproof.plans.fixtures import AS_OF, tx_raw
    from lakeproof.plans.jobs import run_all, silver_job
    from lakeproof.plans.silver import plan_silver
    from lakeproof.session import local_session, scratch_path
    from lakeproof.sources.paths import LakePaths

    cpus = int(CPUS)
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app_name="lakeproof-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakeproof-bench-ckpt-")})

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # Bronze layer of the batch, written once: every Silver run reads it.
    bronze = scratch_path(spark, "bench-bronze")
    tx_raw(spark, SF_DIR).write.mode("overwrite").parquet(bronze)
    silver_once = scratch_path(spark, "bench-silver")
    plan = plan_silver(spark.read.parquet(bronze), TX_CONTRACT, AS_OF)
    plan.valid().write.mode("overwrite").parquet(silver_once)

    def silver_fused(source=bronze, contract=TX_CONTRACT, as_of=AS_OF):
        out = scratch_path(spark, "bench-fused")
        silver_job(spark, source, f"{out}/silver", f"{out}/quarantine", f"{out}/reports", contract, as_of)

    def silver_multipass(source=bronze, contract=TX_CONTRACT, as_of=AS_OF):
        # One action per figure over plain dropDuplicates and filters: raw count,
        # distinct count, valid count, quarantine count, one wide aggregate, one
        # distinct collect per categorical column, one numeric collect, two
        # writes; nothing cached.
        out = scratch_path(spark, "bench-multi")
        raw = spark.read.parquet(source)
        raw.count()
        typed = apply_types(raw.dropDuplicates(), contract)
        typed.count()
        rules = compile_rules(contract, typed.columns, as_of)
        v = typed.where(rules.ok())
        q = typed.where(~rules.ok()).withColumn("rejection_reason", rules.reason())
        v.count()
        q.count()
        aggs = []
        for c in rules.columns:
            aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)),
                     F.sum(F.when(F.col(c).isNotNull() & ~rules.condition(c), 1).otherwise(0))]
        typed.select(*aggs).collect()
        for c in rules.categorical:
            typed.select(c).distinct().collect()
        typed.select(*[f(c) for c in rules.numeric for f in (F.min, F.max, F.avg)]).collect()
        v.write.mode("overwrite").parquet(f"{out}/silver")
        q.write.mode("overwrite").parquet(f"{out}/quarantine")

    def silver_layer():
        return spark.read.parquet(silver_once)

    # Report history as the dashboard reads it: one report per batch on storage.
    from lakeproof.sources.readers import read_reports
    from lakeproof.sources.writers import write_report
    history = scratch_path(spark, "bench-reports")
    p0 = plan_silver(spark.read.parquet(bronze), TX_CONTRACT, AS_OF)
    write_report(p0.report(p0.stats(), AS_OF), history, "20260101_000000_000000")
    profile = scratch_path(spark, "bench-profile")
    p0.profile().write.parquet(profile)

    def report_df():
        return read_reports(spark, history)

    def run_all_job():
        run_all(spark, LakePaths(scratch_path(spark, "bench-runall")), TX_CONTRACT, AS_OF,
                raw=spark.read.parquet(bronze))

    lineitem = os.path.join(SF_DIR, "lineitem.parquet")

    cases = {
        "silver_fused": silver_fused,
        "silver_multipass": silver_multipass,
        "silver_fused_lineitem": lambda: silver_fused(lineitem, Q.LINEITEM_CONTRACT, Q.LINEITEM_AS_OF),
        "silver_multipass_lineitem": lambda: silver_multipass(lineitem, Q.LINEITEM_CONTRACT, Q.LINEITEM_AS_OF),
        "gold_region_risk": lambda: noop(gold.region_risk(silver_layer())),
        "gold_top_sales_window": lambda: noop(gold.top_sales(silver_layer())),
        "gold_top_sales_max_by": lambda: noop(gold.top_k(
            gold.latest_per_key_agg(gold.sales_only(silver_layer()), "receiving_address",
                                    ["timestamp", "amount"], ["amount", "timestamp"]),
            [F.col("amount").desc(), F.col("receiving_address").asc()], 3,
            ["receiving_address", "amount", "timestamp"])),
        "latest_per_address": lambda: noop(gold.latest_sale_per_address(silver_layer())),
        "latest_per_address_max_by": lambda: noop(gold.latest_per_key_agg(
            gold.sales_only(silver_layer()), "receiving_address", ["timestamp", "amount"],
            ["amount", "timestamp"])),
        "categorical_profile": lambda: noop(quality.categorical_profile(
            plan_silver(spark.read.parquet(bronze), TX_CONTRACT, AS_OF).typed(), TX_CONTRACT.categorical)),
        "dashboard_ops": lambda: [noop(df) for df in (
            observe.kpi_volumes(report_df()), observe.column_status(report_df()), observe.issue_ranking(report_df()),
            observe.category_drift(spark.read.parquet(profile)))],
        "run_all": run_all_job,
        "lineitem_column_quality": lambda: noop(Q.q_lineitem_column_quality(spark, SF_DIR)),
        "orders_latest_per_customer": lambda: noop(Q.q_orders_latest_per_customer(spark, SF_DIR)),
        "local_time": lambda: noop(Q.q_local_time(spark, SF_DIR)),
    }

    # Warm every case up first, then interleave the timed rounds so JIT
    # warm-up and machine noise spread evenly over the cases.
    for fn in cases.values():
        fn()
    runs: dict[str, list[float]] = {name: [] for name in cases}
    for _ in range(REPEAT):
        for name, fn in cases.items():
            t0 = time.perf_counter()
            fn()
            runs[name].append(time.perf_counter() - t0)
    timings = {name: round(statistics.median(r), 4) for name, r in runs.items()}

    headline = [k for k in timings
                if k not in ("silver_multipass", "silver_multipass_lineitem", "gold_top_sales_max_by",
                             "latest_per_address_max_by")]
    out = {
        "metric": "total_median_sec",
        "value": round(sum(timings[k] for k in headline), 4),
        "unit": "sec",
        "queries": timings,
        "sf": _sf_of(SF_DIR),
        "cpus": cpus,
        "repeat": REPEAT,
        "spark": spark.version,
        "baseline_silver_multipass_over_fused": round(timings["silver_multipass"] / timings["silver_fused"], 3),
        "baseline_lineitem_multipass_over_fused": round(
            timings["silver_multipass_lineitem"] / timings["silver_fused_lineitem"], 3),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
