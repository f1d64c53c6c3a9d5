"""The fused Silver plan: one data shuffle, then narrow work and small aggregates.

    raw --groupBy(all columns) with copy count--> distinct rows   (the only data shuffle)
        --lenient casts--> typed --rule flags--> flagged          (narrow, codegen)
    flagged --one global aggregate--> batch stats (1 row)          (map-side partials)
    flagged --filter ok--> Silver      flagged --filter not ok--> quarantine
    flagged[categorical columns] --grouped count--> profile       (column_name, value, n)

The Silver job (``plans.jobs.silver_job``) writes ``flagged`` once to shared
scratch, apart by verdict, and observes the batch stats during that write; the
layers and the profile read it instead of redoing the dedup shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from lakeproof.contract import TX_CONTRACT, Contract
from lakeproof.functions.rules import CompiledRules, compile_rules, utc_text
from lakeproof.operators import quality
from lakeproof.operators.shape import MULTIPLICITY, apply_types, dedup_exact, unmapped_columns
from lakeproof.operators.split import OK, flag, flag_columns, quarantine, valid


def resolve_as_of(as_of: str | datetime | None) -> str:
    """A fixed instant for the whole batch (UTC now when not given)."""
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    return utc_text(as_of) if isinstance(as_of, datetime) else as_of


@dataclass
class SilverPlan:
    flagged: DataFrame
    rules: CompiledRules
    unmapped: list[str]
    contract: Contract
    as_of: str

    def valid(self) -> DataFrame:
        return valid(self.flagged).drop(MULTIPLICITY)

    def quarantine(self) -> DataFrame:
        return quarantine(self.flagged, self.rules).drop(MULTIPLICITY)

    def typed(self) -> DataFrame:
        return self.flagged.drop(OK, MULTIPLICITY, *flag_columns(self.flagged))

    def stats(self) -> DataFrame:
        return quality.batch_stats(self.flagged, self.rules)

    def profile(self) -> DataFrame:
        """(column_name, value, n) of the categorical columns (distributed)."""
        return quality.categorical_profile(self.flagged, self.rules.categorical)

    def report(self, stats: DataFrame | None = None, execution_date: str | None = None,
               profile: DataFrame | None = None) -> DataFrame:
        """One-row report; categorical lists and counts come from ``profile``.

        Without a written ``profile`` it is computed here, over a dedup of its own.
        """
        cats = {}
        if self.rules.categorical:
            cats = quality.categorical_lists(self.profile() if profile is None else profile, self.contract.domains)
        return quality.dq_report(stats if stats is not None else self.stats(), self.rules,
                                 self.unmapped, execution_date, self.contract.threshold_pct, cats)


def plan_silver(raw: DataFrame, contract: Contract = TX_CONTRACT,
                as_of: str | datetime | None = None) -> SilverPlan:
    """Lazy Silver plan over a raw batch; nothing runs until an action."""
    instant = resolve_as_of(as_of)
    counted = dedup_exact(raw, contract, count_col=MULTIPLICITY)
    drift = unmapped_columns(counted, contract.expected)
    typed = apply_types(counted, contract)
    rules = compile_rules(contract, [c for c in typed.columns if c != MULTIPLICITY], instant)
    return SilverPlan(flag(typed, rules), rules, drift, contract, instant)
