"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tests.parity [sf_dir] [name ...]

Comparison: same column names, same row count, the same multiset of rows
after sorting columns by name (floats compared after rounding to 9
significant digits, timestamps as naive UTC), and the same result types
(integer width, float width, decimal vs double, timestamp, string, boolean).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, float(f"{v:.9g}"))
    if isinstance(v, bool):
        return (2, v)
    if isinstance(v, int):
        return (1, float(v))
    if hasattr(v, "as_tuple"):  # Decimal
        return (1, float(f"{float(v):.9g}"))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, tuple(_norm(x) for x in v))
    return (5, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(columns)


_SPARK_KIND = {"ByteType": "int8", "ShortType": "int16", "IntegerType": "int32", "LongType": "int64",
               "FloatType": "float32", "DoubleType": "float64", "StringType": "string",
               "BooleanType": "bool", "TimestampType": "timestamp", "TimestampNTZType": "timestamp",
               "DateType": "date", "DecimalType": "decimal"}
_DUCK_KIND = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64",
              "HUGEINT": "int128", "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string",
              "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date"}


def spark_kinds(df) -> dict:
    out = {}
    for f in df.schema.fields:
        name = type(f.dataType).__name__
        out[f.name] = _SPARK_KIND.get(name, f.dataType.simpleString())
    return out


def duck_kinds(rel) -> dict:
    out = {}
    for name, typ in zip(rel.columns, rel.types):
        t = str(typ).upper()
        out[name] = "decimal" if t.startswith("DECIMAL") else _DUCK_KIND.get(t, t.lower())
    return out


def compare(spark, sf_dir, names=None, con=None, verbose=True):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    qs, oracles = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as exc:  # noqa: BLE001
            results[name] = f"spark error: {type(exc).__name__}: {str(exc)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in oracles:
            results[name] = f"rows-only ({len(srows)} rows)"
            if verbose:
                print(f"{name:32s} {results[name]}  spark {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(oracles[name])
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"duckdb error: {str(exc)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        s_c, s_names = canon(scols, srows)
        d_c, d_names = canon(dcols, drows)
        sk, dk = spark_kinds(sdf), duck_kinds(con.sql(oracles[name]))
        type_diff = {c: (sk[c], dk.get(c)) for c in sk if sk[c] != dk.get(c)}
        if s_names != d_names:
            status = f"COLUMNS differ spark={s_names} duck={d_names}"
        elif len(s_c) != len(d_c):
            status = f"ROWCOUNT differ spark={len(s_c)} duck={len(d_c)}"
        elif s_c != d_c:
            bad = [(a, b) for a, b in zip(s_c, d_c) if a != b][:2]
            status = f"VALUES differ e.g. {bad}"
        elif type_diff:
            status = f"TYPES differ (spark, duck): {type_diff}"
        else:
            status = "ok"
        results[name] = status
        if verbose:
            print(f"{name:32s} {status[:400]}  rows={len(srows)} spark {ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from lakeproof.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "ok" and not v.startswith("rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
