"""Command line: run the layers of a lake one by one or all together.

    python -m lakeproof run     --base /lake --source /landing/batch.csv
    python -m lakeproof bronze  --base /lake --source /landing/batch.csv
    python -m lakeproof silver  --base /lake
    python -m lakeproof gold    --base /lake
    python -m lakeproof report  --base /lake [--batch-id ID]
    python -m lakeproof compact --base /lake --path /lake/silver/dq_reports_table
    python -m lakeproof preview --path /lake/silver/fraud_data_clean --limit 250

Under ``spark-submit`` the cluster's session settings apply; the engine only
adds its own defaults (UTC clock, AQE) where they are unset.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeproof.session import ENGINE_CONF


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("lakeproof").getOrCreate()
    for key, value in ENGINE_CONF.items():
        if key != "spark.ui.enabled" and spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakeproof")
    parser.add_argument("command", choices=["run", "bronze", "silver", "gold", "report", "preview", "compact"])
    parser.add_argument("--base", help="lake base folder")
    parser.add_argument("--source", help="raw CSV file or folder")
    parser.add_argument("--infer", action="store_true", help="infer CSV types (extra scan)")
    parser.add_argument("--as-of", help="instant for 'not after now' rules (default: now, UTC)")
    parser.add_argument("--batch-id")
    parser.add_argument("--path")
    parser.add_argument("--limit", type=int, default=250)
    args = parser.parse_args(argv)

    from lakeproof.operators import observe
    from lakeproof.operators.gates import QualityGateError, circuit_breaker
    from lakeproof.plans import jobs
    from lakeproof.sources import LakePaths, compact_reports, preview, read_layer, read_reports, select_report

    spark = _session()
    paths = LakePaths(args.base or ".", source_csv=args.source)
    try:
        if args.command == "run":
            result = jobs.run_all(spark, paths, as_of=args.as_of, infer=args.infer)
            print(result.breaker_message)
        elif args.command == "bronze":
            jobs.bronze_ingest(spark, paths.source, paths.bronze, infer=args.infer)
        elif args.command == "silver":
            result = jobs.silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports,
                                     as_of=args.as_of, profiles_path=paths.profiles)
            print(json.dumps(result.verdict()))
            print(circuit_breaker(result.verdict()))
        elif args.command == "gold":
            last = select_report(read_reports(spark, paths.reports)).first()
            print(circuit_breaker({"conformity_pct": last["metrics"]["conformity_rate_pct"]}))
            jobs.gold_region_risk(spark, paths.silver, paths.region_risk)
            jobs.gold_top_sales(spark, paths.silver, paths.top_sales)
        elif args.command == "report":
            chosen = select_report(read_reports(spark, paths.reports), args.batch_id)
            for op in (observe.kpi_volumes, observe.batch_status, observe.audit_counts,
                       observe.issue_ranking, observe.numeric_stats):
                op(chosen).show(truncate=False)
            profile = read_layer(spark, paths.profiles).join(F.broadcast(chosen.select("batch_id")), "batch_id")
            observe.profile_drift(profile).orderBy(F.col("n").desc()).show(truncate=False)
        elif args.command == "compact":
            compact_reports(spark, paths.reports, args.path)
        elif args.command == "preview":
            preview(spark, args.path, args.limit).show(args.limit, truncate=False)
    except QualityGateError as err:
        print(str(err), file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
