"""Rule flags and the exact valid / quarantine split (V1-V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.rules import CompiledRules
from lakeproof.functions.sqltext import ident

OK = "__ok"
REASON = "rejection_reason"
FLAG_PREFIX = "__v_"


def flag_column(column: str) -> str:
    return FLAG_PREFIX + column


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(FLAG_PREFIX)]


def flag(df: DataFrame, rules: CompiledRules) -> DataFrame:
    """Add one validity flag per ruled column and the row verdict.

    Each condition (regexes included) is evaluated once per row; the verdict,
    the quality counts and the rejection reason all read the flags. Hard
    flags and the verdict are never NULL; a soft flag is NULL when its value is.
    """
    flags = df.selectExpr("*", *[f"{rules.condition_sql(c)} AS {ident(flag_column(c))}"
                                 for c in rules.columns])
    verdict = " AND ".join(ident(flag_column(c)) for c in rules.hard) or "TRUE"
    return flags.withColumn(OK, F.expr(verdict))


def rule_flags(df: DataFrame, rules: CompiledRules, prefix: str = "ok_") -> DataFrame:
    """One boolean per ruled column: hard = passes, soft = NULL when the value is NULL."""
    return df.selectExpr("*", *[f"{rules.condition_sql(name)} AS {ident(prefix + name)}"
                                for name in rules.columns])


def valid(flagged: DataFrame) -> DataFrame:
    """Rows meeting every hard rule, without extra columns."""
    return flagged.filter(F.col(OK)).drop(OK, *flag_columns(flagged))


def quarantine(flagged: DataFrame, rules: CompiledRules) -> DataFrame:
    """The exact complement of ``valid`` plus the reasons for rejection."""
    present = set(flag_columns(flagged))
    flags = {c: ident(flag_column(c)) for c in rules.hard if flag_column(c) in present}
    rejected = flagged.filter(~F.col(OK)).withColumn(REASON, F.expr(rules.reason_sql(flags)))
    return rejected.drop(OK, *present)


def reason_counts(quarantined: DataFrame) -> DataFrame:
    """Rejected rows per distinct reason text."""
    return quarantined.groupBy(REASON).count().withColumnRenamed("count", "n")


def split_counts(flagged: DataFrame) -> DataFrame:
    """(valid_records, error_records) in one pass."""
    return flagged.selectExpr(f"count_if({ident(OK)}) AS valid_records",
                              f"count_if(NOT {ident(OK)}) AS error_records")


def counts_by_level(rows: DataFrame, columns: list[str], min_rows: int = 1) -> DataFrame:
    """``columns``, ``level`` (the grouping id: a bit is 1 where the column is
    summed up, the first column highest) and ``n_rows``, for every subset of
    ``columns``; groups under ``min_rows`` are left out.

    The rows are counted by all columns first, so only that small table is
    spread over the subsets. A null value and a total differ by ``level``.
    """
    clash = sorted({"level", "n_rows"} & set(columns))
    if clash:
        raise ValueError(f"columns named like the result's: {clash}")
    finest = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return (finest.cube(*columns).agg(F.grouping_id().alias("level"), F.sum("n_rows").alias("n_rows"))
            .where(F.col("n_rows") >= min_rows).select(*columns, "level", "n_rows"))
