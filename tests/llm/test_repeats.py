"""Repeated word windows against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeproof.llm import repeats
from lakeproof.llm.common import materialise
from lakeproof.llm.repeats import levels, op13_doubling_substring_dedup, without_repeats


def brute(rows, length=20):
    """rows: (doc_id, text); Counter of (doc_id, n_words, n_removed, kept_sha256)."""
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    order = sorted((d is not None, d or 0, s, i) for i, (d, _) in enumerate(rows)
                   for s in range(len(words[i]) - length + 1))
    gone = [[False] * len(w) for w in words]
    for _, _, s, i in order:
        if first.setdefault(tuple(words[i][s:s + length]), (i, s)) != (i, s):
            gone[i][s:s + length] = [True] * length
    return Counter((d, len(w), sum(g), hashlib.sha256(b" ".join(x for x, y in zip(w, g) if not y)).hexdigest())
                   for (d, _), w, g in zip(rows, words, gone))


def got(frame):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())


def test_awkward_table(spark, tables, rows):
    want = brute(rows)
    assert got(op13_doubling_substring_dedup(spark, tables)) == want
    assert any(n for _, _, n, _ in want)


@pytest.mark.parametrize("length,start", [(20, 5), (20, 20), (16, 1), (7, 3), (20, 10)])
def test_any_length_and_start(spark, tmp_path, monkeypatch, length, start):
    """Few different words, so that windows repeat within and across rows at
    every length; ids beside 2**63 among nulls; small limits so that the state
    in a task is dropped and batches are cut within the table."""
    monkeypatch.setattr(repeats, "SEEN", 50)
    monkeypatch.setattr(repeats, "HELD", 300)
    rng = random.Random(length * 31 + start)
    pool = [" ".join(rng.choice("abcd") + rng.choice(["", "é", "x"]) for _ in range(rng.randint(1, 60))) for _ in range(25)]
    texts = [rng.choice([" ", "\n", "\t \x0b"]).join(rng.choices(pool, k=rng.randint(0, 4))) for _ in range(160)]
    texts += [None, "", " \n ", texts[0], texts[0], "a " * 500, " x\x0cy z " * 30]
    ids = [(1 << 63) - 1 - i if i % 7 else None for i in range(len(texts))]
    ids[-2] = ids[3]
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("rid", F.lit("clash"))
    out = without_repeats(docs, length, start).withColumn("kept_sha256", F.sha2("kept", 256))
    assert got(out) == brute(rows, length)


def test_levels_double():
    assert levels(20, 5) == [5, 10, 20] and levels(20, 20) == [20] and levels(7, 3) == [7] and levels(64, 8) == [8, 16, 32, 64]


def test_hot_window_sends_two_rows_a_task(spark):
    """A passage in every row leaves a task as its first place and one notice."""
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(400, numPartitions=2).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(passage + " tail"), F.col("id").cast("string")).alias("text"))
    texts = materialise(docs.withColumn("rid", F.monotonically_increasing_id()), "hot")
    rows = texts.select("rid", "text").mapInArrow(
        repeats._level_rows(20, 5, 5, None, None), "h long, rid long, pos int, n int").where("n = 1")
    assert max(r["count"] for r in rows.groupBy("h").count().collect()) <= 2 * texts.rdd.getNumPartitions()


def test_sql_says_the_same(spark, tmp_path, rows):
    seen, unique = set(), []
    for d, t in rows:
        if d is not None and d not in seen:
            seen.add(d)
            unique.append((d, t))
    pq.write_table(pa.table({"doc_id": pa.array([d for d, _ in unique], pa.int64()),
                             "text": pa.array([t for _, t in unique], pa.string())}), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    cols = [c[0] for c in con.execute(repeats.ORACLE).description]
    said = Counter(tuple(dict(zip(cols, r))[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256"))
                   for r in con.fetchall())
    assert got(op13_doubling_substring_dedup(spark, str(tmp_path))) == said == brute(unique)
