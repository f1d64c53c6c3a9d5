"""Compile rule records into Spark SQL predicates.

Every compiled hard condition is null-safe: ``isNotNull AND predicate``
folded to FALSE when the predicate is NULL, so ``filter(ok)`` and
``filter(NOT ok)`` split a batch exactly. A soft condition is the bare
predicate; its invalid count is ``isNotNull AND NOT predicate``, so a NULL in
an optional column is neither valid nor invalid.

Conditions are kept as SQL expression text (one JVM call per projection);
``condition()``/``ok()``/``reason()`` wrap them as Columns for callers that
compose with the DataFrame API.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeproof.contract import REASON_SEPARATOR, Contract, Rule
from lakeproof.functions.sqltext import ident, literal, string


def utc_text(instant: datetime) -> str:
    if instant.tzinfo is not None:
        instant = instant.astimezone(timezone.utc)
    return instant.strftime("%Y-%m-%d %H:%M:%S.%f") + "+00:00"


def as_of_sql(as_of: str | datetime | None) -> str:
    """One instant per batch. A datetime is an instant whatever the session
    zone (naive: UTC); text without an offset is read in the session zone."""
    if as_of is None:
        return "current_timestamp()"
    if isinstance(as_of, datetime):
        as_of = utc_text(as_of)
    return f"CAST({string(as_of)} AS TIMESTAMP)"


def predicate_sql(rule: Rule, as_of: str) -> str:
    c = ident(rule.column)
    a = rule.args
    if rule.kind == "not_null":
        return f"{c} IS NOT NULL"
    if rule.kind == "min":
        return f"{c} >= {literal(a['value'])}"
    if rule.kind == "positive":
        return f"{c} > 0"
    if rule.kind == "between":
        return f"{c} BETWEEN {literal(a['low'])} AND {literal(a['high'])}"
    if rule.kind == "not_after":
        return f"{c} <= {as_of}"
    if rule.kind == "in_domain":
        return f"{c} IN ({', '.join(literal(v) for v in a['values'])})"
    if rule.kind == "matches":
        return f"{c} RLIKE {string(a['pattern'])}"
    raise ValueError(rule.kind)


@dataclass
class CompiledRules:
    """SQL conditions per ruled column, in contract order."""

    hard: dict[str, str]
    soft: dict[str, str]
    messages: dict[str, str]
    categorical: list[str]
    numeric: list[str]
    advisory: dict[str, str]  # soft rules of columns that have hard ones too

    @property
    def columns(self) -> list[str]:
        return list(self.hard) + list(self.soft)

    def severity(self, column: str) -> str:
        return "hard" if column in self.hard else "soft"

    def condition_sql(self, column: str) -> str:
        return self.hard[column] if column in self.hard else self.soft[column]

    def ok_sql(self) -> str:
        """Conjunction of all hard conditions (TRUE when there are none)."""
        return " AND ".join(f"({c})" for c in self.hard.values()) or "TRUE"

    def reason_sql(self, flags: dict[str, str] | None = None) -> str:
        """Failed hard-rule messages joined in fixed order; passing rules skipped.

        ``flags`` maps a column to an already computed validity flag to read
        instead of re-evaluating its condition.
        """
        if not self.hard:
            return "''"
        flags = flags or {}
        parts = ", ".join(f"CASE WHEN NOT ({flags.get(name, cond)}) THEN {string(self.messages[name])} END"
                          for name, cond in self.hard.items())
        return f"concat_ws({string(REASON_SEPARATOR)}, array({parts}))"

    def condition(self, column: str) -> Column:
        return F.expr(self.condition_sql(column))

    def ok(self) -> Column:
        return F.expr(self.ok_sql())

    def reason(self) -> Column:
        return F.expr(self.reason_sql())


def compile_rules(contract: Contract, columns, as_of: str | datetime | None = None) -> CompiledRules:
    """Rules of ``contract`` active for a frame with ``columns``.

    Hard rules always apply (required columns are enforced at ingest); a soft
    rule exists only when its column is present.
    """
    instant = as_of_sql(as_of)
    grouped: dict[str, list[Rule]] = {}
    for rule in contract.rules_for(columns):
        grouped.setdefault(rule.column, []).append(rule)
    hard: dict[str, str] = {}
    soft: dict[str, str] = {}
    messages: dict[str, str] = {}
    advisory: dict[str, str] = {}
    for name, rules in grouped.items():
        blocking = [r for r in rules if r.severity == "hard"]
        pred = {kind: " AND ".join(f"({predicate_sql(r, instant)})" for r in rules if r.severity == kind)
                for kind in ("hard", "soft")}
        if blocking:
            hard[name] = f"coalesce({ident(name)} IS NOT NULL AND {pred['hard']}, FALSE)"
            told = list(dict.fromkeys(r.message for r in blocking if r.message))
            messages[name] = REASON_SEPARATOR.join(told) or f"invalid {name}"
            if pred["soft"]:
                advisory[name] = pred["soft"]
        else:
            soft[name] = pred["soft"]
    present = set(columns)
    categorical = [c for c in contract.categorical
                   if c in present and (c in hard or c in soft or c in contract.required)]
    numeric = [c for c in contract.numeric_profile if c in present]
    return CompiledRules(hard, soft, messages, categorical, numeric, advisory)
