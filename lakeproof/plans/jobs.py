"""Composite jobs: Bronze, Silver + quality, breaker, Gold, full run.

Jobs take a session and never stop it; layers are handed over through
storage, so any layer can be rebuilt on its own.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeproof.contract import TX_CONTRACT, Contract
from lakeproof.functions.sqltext import ident, typed_literal
from lakeproof.operators import gold, quality
from lakeproof.operators.gates import circuit_breaker, require_columns, require_non_empty
from lakeproof.operators.split import OK
from lakeproof.plans.silver import SilverPlan, plan_silver
from lakeproof.session import drop_path, input_bytes, scratch_path, sized_shuffle
from lakeproof.sources.paths import LakePaths
from lakeproof.sources.readers import malformed, read_layer, read_raw, read_raw_checked, well_formed
from lakeproof.sources.writers import new_batch_id, write_layer, write_report


def bronze_ingest(spark: SparkSession, source: str, target: str, contract: Contract = TX_CONTRACT,
                  schema=None, infer: bool = False, malformed_path: str | None = None,
                  columns: list[str] | None = None) -> DataFrame:
    """CSV batch -> non-empty gate -> required-columns gate -> Parquet Bronze.

    With ``malformed_path`` lines with too many or too few fields go there
    with their reason instead of being cut or padded; the batch is parsed once,
    into shared scratch, and read twice from there. ``columns`` then names the
    columns of files without a header row.
    """
    if malformed_path is None:
        raw, parsed = read_raw(spark, source, schema=schema, infer=infer), None
    else:
        parsed = scratch_path(spark, "parsed")
        write_layer(read_raw_checked(spark, source, columns), parsed)
        checked = read_layer(spark, parsed)
        write_layer(malformed(checked), malformed_path)
        raw = well_formed(checked)
    require_non_empty(raw)
    require_columns(raw, contract.required)
    write_layer(raw, target)
    if parsed:
        drop_path(spark, parsed)
    return read_layer(spark, target)


@dataclass
class SilverResult:
    conformity_pct: float
    batch_id: str
    plan: SilverPlan

    def verdict(self) -> dict:
        return {"conformity_pct": self.conformity_pct}


def silver_job(spark: SparkSession, bronze_path: str, silver_path: str, quarantine_path: str,
               reports_path: str, contract: Contract = TX_CONTRACT, as_of=None,
               batch_id: str | None = None, raw: DataFrame | None = None,
               profiles_path: str | None = None) -> SilverResult:
    """Dedup, type, validate, split, profile; write Silver, quarantine and the report.

    One data shuffle. The flagged rows are written once to shared scratch,
    partitioned by verdict; ``observe`` computes every count and statistic of
    the report in that write. Each layer then reads its own partition, and the
    profile its few columns; a lost executor costs no second dedup. The
    categorical profile ``(column_name, value, n)`` of the batch is a table of
    its own (``profiles_path/batch_id=<id>``); the report embeds the found
    values of the closed domains and exact counts of distinct and drifted
    values. Shuffle partitions are sized to the Bronze layer while the job
    runs; the scratch is deleted at its end.
    """
    profiles_path = profiles_path or os.path.join(os.path.dirname(reports_path.rstrip("/")), "dq_profiles")
    batch_id = batch_id or new_batch_id()
    source = raw if raw is not None else read_layer(spark, bronze_path)
    plan = plan_silver(source, contract, as_of)
    lazy = plan.flagged
    work = scratch_path(spark, "silver-flagged")
    try:
        with sized_shuffle(spark, input_bytes(source) if raw is None else 0):
            observation = Observation(f"silver_batch_stats_{uuid.uuid4().hex}")
            exprs = quality.batch_stats_exprs(lazy, plan.rules)
            lazy.observe(observation, *[F.expr(e) for e in exprs]).write.partitionBy(OK).parquet(work)
            plan.flagged = spark.read.schema(lazy.schema).parquet(work)
            write_layer(plan.valid(), silver_path)
            write_layer(plan.quarantine(), quarantine_path)
            schema = quality.batch_stats(lazy, plan.rules).schema
            values = observation.get
            # The one observed row as a literal frame: projections over it fold into a
            # local relation, so reading the verdict below runs no Spark job.
            stats = spark.sql("SELECT " + ", ".join(
                f"{typed_literal(values[f.name], f.dataType.simpleString())} AS {ident(f.name)}"
                for f in schema.fields))
            profile_path = f"{profiles_path.rstrip('/')}/batch_id={batch_id}"
            profile = plan.profile()
            write_layer(profile, profile_path)
            executed = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
            report = plan.report(stats, executed, profile=spark.read.schema(profile.schema).parquet(profile_path))
            batch_id = write_report(report, reports_path, batch_id)
            metrics = quality.batch_metrics(stats, plan.rules, plan.unmapped, contract.threshold_pct).first()
    finally:
        plan.flagged = lazy
        drop_path(spark, work)
    return SilverResult(float(metrics["conformity_rate_pct"]), batch_id, plan)


def gold_region_risk(spark: SparkSession, silver_path: str, target: str) -> DataFrame:
    out = gold.region_risk(read_layer(spark, silver_path))
    write_layer(out, target)
    return read_layer(spark, target)


def gold_top_sales(spark: SparkSession, silver_path: str, target: str, k: int = 3) -> DataFrame:
    out = gold.top_sales(read_layer(spark, silver_path), k)
    write_layer(out, target)
    return read_layer(spark, target)


@dataclass
class RunResult:
    silver: SilverResult
    breaker_message: str
    paths: LakePaths


def run_all(spark: SparkSession, paths: LakePaths, contract: Contract = TX_CONTRACT, as_of=None,
            schema=None, infer: bool = False, raw: DataFrame | None = None) -> RunResult:
    """Bronze -> Silver -> breaker -> both Gold tables.

    ``raw`` lets a caller hand in an already-read batch instead of the CSV.
    When the breaker trips, the report, Silver and quarantine are already
    written and Gold keeps its last good state.
    """
    if raw is None:
        bronze_ingest(spark, paths.source, paths.bronze, contract, schema, infer)
    else:
        require_non_empty(raw)
        require_columns(raw, contract.required)
        write_layer(raw, paths.bronze)
    silver = silver_job(spark, paths.bronze, paths.silver, paths.quarantine, paths.reports,
                        contract, as_of, profiles_path=paths.profiles)
    message = circuit_breaker(silver.verdict(), contract.threshold_pct)
    gold_region_risk(spark, paths.silver, paths.region_risk)
    gold_top_sales(spark, paths.silver, paths.top_sales)
    return RunResult(silver, message, paths)
