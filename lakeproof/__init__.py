"""lakeproof: layered batch data-quality engine on Spark DataFrames.

Raw batches land in Bronze behind emptiness and required-column gates;
Silver de-duplicates, types leniently and validates against a contract of
blocking and advisory rules, sending failing rows to quarantine with their
reasons; every batch is profiled into a report history; a circuit breaker
stops promotion when conformity is low; Gold publishes aggregates.
"""

from lakeproof.contract import TX_CONTRACT, Contract, Rule
from lakeproof.plans.jobs import (bronze_ingest, gold_region_risk, gold_top_sales, run_all,
                                  silver_job)
from lakeproof.plans.silver import plan_silver
from lakeproof.sources.paths import LakePaths

__all__ = ["Contract", "LakePaths", "Rule", "TX_CONTRACT", "bronze_ingest", "gold_region_risk",
           "gold_top_sales", "plan_silver", "run_all", "silver_job"]
