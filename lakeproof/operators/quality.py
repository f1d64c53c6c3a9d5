"""Batch quality aggregates, profiles and the report document (Q1-Q12).

Every count and statistic of the report comes out of ONE global aggregate
over the de-duplicated, typed, flagged batch (``batch_stats``): row counts,
per-column null and invalid counts, numeric min/max/avg. Each is a partial
aggregate computed map-side, so the final merge sees one small fixed-size row
per input partition. The long-form tables (column quality, metrics, numeric
profile) are projections of that one row.

Categorical values are not gathered by that aggregate: a column that drifts
to free text could hold billions of distinct values. They come from the
distributed profile ``(column_name, value, n)``, a table of its own; the
report embeds the found values of the contract's closed domains together with
the exact numbers of distinct and drifted values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.contract import CIRCUIT_BREAKER_THRESHOLD_PCT
from lakeproof.functions.rules import CompiledRules
from lakeproof.functions.sqltext import ident, literal, pct, string, string_array, total
from lakeproof.operators.shape import MULTIPLICITY
from lakeproof.operators.split import OK, flag_column

REPORT_DDL = (
    "execution_date string, "
    "metrics struct<total_records bigint, total_errors bigint, total_alerts bigint, "
    "duplicate_records bigint, unmapped_columns array<string>, error_rate_pct double, "
    "conformity_rate_pct double, circuit_breaker_threshold_pct double>, "
    "anomalies struct<missing_values bigint, invalid_values bigint>, "
    "column_quality map<string, struct<valid bigint, `null` bigint, invalid bigint, "
    "completeness_pct double, validity_pct double>>, "
    "eda struct<categorical map<string, array<string>>, "
    "numeric map<string, struct<min double, max double, avg double>>, "
    "categorical_distinct map<string, bigint>, categorical_drifted map<string, bigint>>"
)
_CQ_TYPE = ("MAP<STRING, STRUCT<valid: BIGINT, `null`: BIGINT, invalid: BIGINT, "
            "completeness_pct: DOUBLE, validity_pct: DOUBLE>>")
_CAT_TYPE = "MAP<STRING, ARRAY<STRING>>"
_NUM_TYPE = "MAP<STRING, STRUCT<min: DOUBLE, max: DOUBLE, avg: DOUBLE>>"


def _n_null(c: str) -> str:
    return f"n__{c}__null"


def _n_invalid(c: str) -> str:
    return f"n__{c}__invalid"


def _n_advisory(c: str) -> str:
    return ident(f"n__{c}__advisory")


def batch_stats(flagged: DataFrame, rules: CompiledRules) -> DataFrame:
    """One-row aggregate with every count and statistic of the batch."""
    return flagged.selectExpr(*batch_stats_exprs(flagged, rules))


def batch_stats_exprs(flagged: DataFrame, rules: CompiledRules) -> list[str]:
    """The aggregate expressions of ``batch_stats`` (also usable with ``observe``)."""
    ok = ident(OK) if OK in flagged.columns else f"({rules.ok_sql()})"
    incoming = (f"CAST(coalesce(sum({ident(MULTIPLICITY)}), 0) AS BIGINT)"
                if MULTIPLICITY in flagged.columns else "count(1)")
    exprs = ["count(1) AS total_records", f"{incoming} AS total_incoming",
             f"count_if({ok}) AS valid_records"]
    for c in rules.columns:
        cond = ident(flag_column(c)) if flag_column(c) in flagged.columns else f"({rules.condition_sql(c)})"
        exprs.append(f"count_if({ident(c)} IS NULL) AS {_n_null(c)}")
        exprs.append(f"count_if({ident(c)} IS NOT NULL AND NOT {cond}) AS {_n_invalid(c)}")
    for c, cond in rules.advisory.items():
        exprs.append(f"count_if({ident(c)} IS NOT NULL AND NOT ({cond})) AS {_n_advisory(c)}")
    for c in rules.numeric:
        exprs += [f"CAST(min({ident(c)}) AS DOUBLE) AS {ident('min__' + c)}",
                  f"CAST(max({ident(c)}) AS DOUBLE) AS {ident('max__' + c)}",
                  f"avg({ident(c)}) AS {ident('avg__' + c)}"]
    return exprs


def _valid(c: str) -> str:
    return f"(total_records - {_n_null(c)} - {_n_invalid(c)})"


def _quality_struct(c: str) -> str:
    return (f"named_struct('valid', {_valid(c)}, 'null', {_n_null(c)}, 'invalid', {_n_invalid(c)}, "
            f"'completeness_pct', {pct(f'total_records - {_n_null(c)}', 'total_records')}, "
            f"'validity_pct', {pct(_valid(c), 'total_records')})")


def column_quality(stats: DataFrame, rules: CompiledRules) -> DataFrame:
    """(column_name, severity, valid, null, invalid, completeness_pct, validity_pct)."""
    entries = ", ".join(
        f"named_struct('column_name', {string(c)}, 'severity', {string(rules.severity(c))}, "
        f"'valid', {_valid(c)}, 'null', {_n_null(c)}, 'invalid', {_n_invalid(c)}, "
        f"'completeness_pct', {pct(f'total_records - {_n_null(c)}', 'total_records')}, "
        f"'validity_pct', {pct(_valid(c), 'total_records')})"
        for c in rules.columns)
    return stats.selectExpr(f"inline(array({entries}))")


def _totals(rules: CompiledRules) -> dict[str, str]:
    return {
        "missing_values": total([_n_null(c) for c in rules.columns]),
        "invalid_values": total([_n_invalid(c) for c in rules.columns]),
        "total_alerts": total([_n_invalid(c) for c in rules.soft] + [_n_advisory(c) for c in rules.advisory]),
    }


def anomaly_totals(stats: DataFrame, rules: CompiledRules) -> DataFrame:
    """(missing_values, invalid_values, total_alerts) over all ruled columns."""
    return stats.selectExpr(*[f"{e} AS {n}" for n, e in _totals(rules).items()])


def _metrics(rules: CompiledRules, unmapped: list[str], threshold: float) -> dict[str, str]:
    errors = "(total_records - valid_records)"
    return {
        "total_records": "total_records",
        "total_errors": errors,
        "total_alerts": _totals(rules)["total_alerts"],
        "duplicate_records": "(total_incoming - total_records)",
        "unmapped_columns": string_array(unmapped),
        "error_rate_pct": pct(errors, "total_records"),
        "conformity_rate_pct": pct("valid_records", "total_records"),
        "circuit_breaker_threshold_pct": literal(float(threshold)),
    }


def batch_metrics(stats: DataFrame, rules: CompiledRules, unmapped: list[str] | None = None,
                  threshold: float = CIRCUIT_BREAKER_THRESHOLD_PCT) -> DataFrame:
    """One row: totals, errors, alerts, duplicates, drift, rates and threshold."""
    return stats.selectExpr(*[f"{e} AS {n}" for n, e in _metrics(rules, unmapped or [], threshold).items()])


def _avg_or_zero(c: str) -> str:
    """Average rounded to 2; 0 when NULL or 0."""
    a = ident("avg__" + c)
    return f"CASE WHEN coalesce({a}, 0.0D) = 0.0D THEN 0.0D ELSE round({a}, 2) END"


def _numeric_struct(c: str) -> str:
    return (f"named_struct('min', {ident('min__' + c)}, 'max', {ident('max__' + c)}, "
            f"'avg', {_avg_or_zero(c)})")


def numeric_profile(stats: DataFrame, rules: CompiledRules) -> DataFrame:
    """(column_name, min, max, avg) of the profiled numeric columns."""
    entries = ", ".join(
        f"named_struct('column_name', {string(c)}, 'min', {ident('min__' + c)}, "
        f"'max', {ident('max__' + c)}, 'avg', {_avg_or_zero(c)})" for c in rules.numeric)
    return stats.selectExpr(f"inline(array({entries}))")


def categorical_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n): distinct non-null values with their counts.

    A distributed table rather than a driver-side list: unpivot, then one
    grouped count with map-side combine; its size is the number of distinct
    values, whatever the number of rows.
    """
    pairs = ", ".join(f"named_struct('column_name', {string(c)}, 'value', CAST({ident(c)} AS STRING))"
                      for c in columns)
    return (df.selectExpr(f"inline(array({pairs}))")
            .where("value IS NOT NULL")
            .groupBy("column_name", "value").count().withColumnRenamed("count", "n"))


def domain_map(domains: dict[str, list[str]]) -> str:
    entries = ", ".join(f"{string(k)}, {string_array(vs)}" for k, vs in domains.items())
    return f"map({entries})" if entries else "CAST(map() AS MAP<STRING, ARRAY<STRING>>)"


def in_domain(domains: dict[str, list[str]]) -> str:
    """Whether ``value`` is in the domain of ``column_name``; a column without
    a declared domain expects no value."""
    return (f"array_contains(coalesce(element_at({domain_map(domains)}, column_name), "
            "CAST(array() AS ARRAY<STRING>)), value)")


def categorical_lists(profile: DataFrame, domains: dict[str, list[str]]) -> dict[str, tuple[list[str], int, int]]:
    """Per column: the values of its closed domain that were found, and the
    exact numbers of distinct and of drifted values.

    The lists are bounded by the contract's domains, without a cut; values
    outside them are counted here and listed by the profile table alone. One
    row per column reaches the driver, aggregated map-side.
    """
    rows = (profile.selectExpr("column_name", "value", f"{in_domain(domains)} AS expected")
            .groupBy("column_name")
            .agg(F.expr("collect_set(CASE WHEN expected THEN value END)").alias("found"),
                 F.expr("count(1)").alias("n"), F.expr("count_if(NOT expected)").alias("drifted")).collect())
    return {r["column_name"]: (sorted(r["found"]), int(r["n"]), int(r["drifted"])) for r in rows}


def dq_report(stats: DataFrame, rules: CompiledRules, unmapped: list[str] | None = None,
              execution_date: str | None = None,
              threshold: float = CIRCUIT_BREAKER_THRESHOLD_PCT,
              categorical: dict[str, tuple[list[str], int, int]] | None = None) -> DataFrame:
    """The batch report as a one-row nested frame (schema ``REPORT_DDL``).

    ``categorical`` maps each profiled column to (found domain values, distinct
    count, drifted count), as returned by ``categorical_lists``; columns
    without values get an empty list.
    """
    metrics = _metrics(rules, unmapped or [], threshold)
    totals = _totals(rules)
    cq = ", ".join(f"{string(c)}, {_quality_struct(c)}" for c in rules.columns)
    categorical = categorical or {}
    cat = ", ".join(f"{string(c)}, {string_array(categorical.get(c, ([], 0, 0))[0])}" for c in rules.categorical)
    cat_n, cat_drift = (", ".join(f"{string(c)}, CAST({int(categorical.get(c, ([], 0, 0))[i])} AS BIGINT)"
                                  for c in rules.categorical) for i in (1, 2))
    num = ", ".join(f"{string(c)}, {_numeric_struct(c)}" for c in rules.numeric)
    executed = (string(execution_date) if execution_date
                else "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")")
    return stats.selectExpr(
        f"{executed} AS execution_date",
        "named_struct(" + ", ".join(f"{string(n)}, {e}" for n, e in metrics.items()) + ") AS metrics",
        f"named_struct('missing_values', {totals['missing_values']}, "
        f"'invalid_values', {totals['invalid_values']}) AS anomalies",
        f"CAST(map({cq}) AS {_CQ_TYPE}) AS column_quality",
        f"named_struct('categorical', CAST(map({cat}) AS {_CAT_TYPE}), "
        f"'numeric', CAST(map({num}) AS {_NUM_TYPE}), "
        f"'categorical_distinct', CAST(map({cat_n}) AS MAP<STRING, BIGINT>), "
        f"'categorical_drifted', CAST(map({cat_drift}) AS MAP<STRING, BIGINT>)) AS eda",
    )
