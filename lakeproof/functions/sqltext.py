"""Spark SQL expression text helpers.

Operators build their expressions as SQL text and hand a whole projection to
``selectExpr`` in one call, so a frame with hundreds of expressions costs one
round trip to the JVM instead of thousands.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """Back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def string(value: str) -> str:
    """Single-quoted Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L" if abs(value) > 2**31 - 1 else str(value)
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)" if "e" in repr(value) or "n" in repr(value) else f"{value!r}D"
    return string(str(value))


def pct(part: str, total: str, digits: int | None = 2) -> str:
    """``part / total * 100`` rounded HALF_UP; 0.0 when the total is 0 or NULL."""
    value = f"CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100.0D"
    if digits is not None:
        value = f"round({value}, {digits})"
    return f"CASE WHEN coalesce({total}, 0) > 0 THEN {value} ELSE 0.0D END"


def total(parts: list[str]) -> str:
    """Sum of bigint terms; 0 when there are none."""
    return " + ".join(parts) if parts else "CAST(0 AS BIGINT)"


def string_array(values: list[str]) -> str:
    return f"CAST(array({', '.join(string(v) for v in values)}) AS ARRAY<STRING>)"


def typed_literal(value, type_sql: str) -> str:
    """A literal of the given Spark SQL type; doubles keep every bit (NaN and infinities too)."""
    if value is None:
        return f"CAST(NULL AS {type_sql})"
    if isinstance(value, float):
        return f"CAST({string(repr(value))} AS {type_sql})"
    if isinstance(value, (list, tuple)):
        return f"CAST(array({', '.join(literal(v) for v in value)}) AS {type_sql})"
    return f"CAST({literal(value)} AS {type_sql})"
