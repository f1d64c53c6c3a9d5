"""Malformed lines, differing headers, batch differences, orphans, matches
along time, and instants in zones with daylight saving."""

import random
from datetime import datetime, timedelta

import pytest

from lakeproof.contract import Contract
from lakeproof.operators.compare import batch_diff, diff_summary
from lakeproof.operators.refer import flag_orphans, orphans, referenced
from lakeproof.operators.shape import MULTIPLICITY, apply_types, dedup_exact, duplicate_count
from lakeproof.operators.temporal import last_before, sessions
from lakeproof.plans.jobs import bronze_ingest
from lakeproof.sources.readers import malformed, read_raw, read_raw_checked, well_formed


def landing(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


# --- raw files

def test_malformed_lines_are_kept_whole(spark, tmp_path):
    path = landing(tmp_path / "in", a='x,y\n1,2\n1,2,3\n4\n\n"5,5",6\n"a\\"b",7\n,\n')
    read_raw_checked(spark, path).write.parquet(str(tmp_path / "parsed"))
    checked = spark.read.parquet(str(tmp_path / "parsed"))
    good = {tuple(r) for r in well_formed(checked).collect()}
    bad = {tuple(r) for r in malformed(checked).collect()}
    assert good == {("1", "2"), ("5,5", "6"), ('a"b', "7"), (None, None)}
    assert bad == {("1,2,3", 3, "too many fields"), ("4", 1, "too few fields")}


def test_bronze_splits_malformed_lines_off(spark, tmp_path):
    contract = Contract(name="t", expected=["x", "y"], required=["x", "y"], types={}, rules=[], categorical=[], numeric_profile=[])
    path = landing(tmp_path / "in", a="x,y\n1,2\n1,2,3\n", b="x,y\n3,4\n5\n")
    out = bronze_ingest(spark, path, str(tmp_path / "bronze"), contract, malformed_path=str(tmp_path / "bad"))
    assert {tuple(r) for r in out.collect()} == {("1", "2"), ("3", "4")}
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


@pytest.mark.parametrize("other", ["y,x\n30,3\n", "x\n3\n", "x,z\n3,30\n"])
def test_a_file_with_another_header_is_refused(spark, tmp_path, other):
    path = landing(tmp_path / "in", a="x,y\n1,10\n2,20\n", b=other)
    with pytest.raises(Exception, match="(?i)csv header"):  # from a task, so no class of PySpark's own
        read_raw(spark, path).collect()
    with pytest.raises(Exception, match="(?i)csv header"):
        read_raw(spark, path, schema="x int, y int").collect()


def test_files_with_one_header_are_one_batch(spark, tmp_path):
    path = landing(tmp_path / "in", a="x,y\n1,10\n", b="x,y\n2,20\n")
    assert {tuple(r) for r in read_raw(spark, path).collect()} == {("1", "10"), ("2", "20")}
    assert {r["y"] for r in read_raw(spark, path).select("y").collect()} == {"10", "20"}


# --- typing and dedup

@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_two_instants_of_a_repeated_hour_stay_two_rows(spark, zone, kind):
    contract = Contract(name="t", expected=["at"], required=["at"], types={"at": kind}, rules=[], categorical=[], numeric_profile=[])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # both pairs are an hour apart across the end of summer time, in Berlin and in Sao Paulo
        rows = [("1667088000",), ("1667091600",), ("1667091600.0",), ("1550368800",), ("1550372400",), ("soon",), (None,)]
        counted = dedup_exact(spark.createDataFrame(rows, "at string"), contract, MULTIPLICITY)
        total = duplicate_count(counted).first()
        assert (total["distinct_records"], total["duplicate_records"]) == (6, 1)
        if kind == "timestamp":
            micros = {r[0] for r in apply_types(counted, contract).selectExpr("unix_micros(at)").collect()}
            assert micros == {1667088000 * 10 ** 6, 1667091600 * 10 ** 6, 1550368800 * 10 ** 6, 1550372400 * 10 ** 6, None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_whole_numbers_in_any_spelling(spark):
    contract = Contract(name="t", expected=["id"], required=["id"], types={"id": "bigint"}, rules=[], categorical=[], numeric_profile=[])
    raw = spark.createDataFrame([("1.0",), ("1e3",), ("9007199254740993",), ("x",), ("9" * 30,)], "id string")
    want = [None, None, 1, 1000, 9007199254740993]
    for df in (raw, dedup_exact(raw, contract)):
        got = [r["id"] for r in apply_types(df, contract).collect()]
        assert sorted(got, key=lambda i: (i is not None, i or 0)) == want


# --- two batches

def test_batch_diff_counts_copies(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, None)], "k int, v string")
    new = spark.createDataFrame([("a", 1), (None, 2), ("d", 4), ("d", 4), (None, None)], "v string, k int")
    diff = batch_diff(old, new)
    assert {tuple(r) for r in diff.collect()} == {(1, "a", 2, 1, "count"), (3, "c", 1, 0, "gone"), (4, "d", 0, 2, "added")}
    assert {tuple(r) for r in diff_summary(diff).collect()} == {("count", 1, 1), ("gone", 1, 1), ("added", 1, 2)}
    assert batch_diff(old, old).count() == 0 and batch_diff(old.limit(0), old.limit(0)).count() == 0
    with pytest.raises(ValueError):
        batch_diff(old, new.withColumnRenamed("v", "w"))


def test_batch_diff_is_one_shuffle_without_a_join(spark):
    plan = batch_diff(spark.range(10).toDF("a"), spark.range(5).toDF("a"))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange") == 1 and "Join" not in physical


# --- orphans

@pytest.mark.parametrize("hot_rows", [7, 10 ** 6])
def test_orphans_with_a_hot_key(spark, hot_rows):
    rng = random.Random(3)
    rows = [(rng.choice([50] * 10 + [None] * 5 + list(range(20))), i) for i in range(600)] + [(50, 0)] * 3
    child = spark.createDataFrame(rows, "k int, i int").repartition(4)
    parent = spark.createDataFrame([(k,) for k in (0, 2, 4, 4, None)], "p int")
    flagged = flag_orphans(child, parent, "k", "p", hot_rows)
    bad = sorted((r["i"], r["k"] is None, r["orphan_reason"]) for r in orphans(flagged).collect())
    assert bad == sorted((i, k is None, "null key" if k is None else "no parent") for k, i in rows if k not in (0, 2, 4))
    assert sorted(map(tuple, referenced(flagged).collect())) == sorted((k, i) for k, i in rows if k in (0, 2, 4))
    assert flag_orphans(child, parent.limit(0), "k", "p", hot_rows).where("orphan_reason IS NULL").count() == 0
    assert flag_orphans(child.limit(0), parent, "k", "p", hot_rows).count() == 0


# --- along time

@pytest.fixture(scope="module")
def moments():
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = [(i, rng.choice([7] * 6 + [None, 1, 2, 3]), start + timedelta(seconds=rng.choice([0, 3600, 1]) * rng.randrange(200)),
             rng.choice("vvpp")) for i in range(500)]
    return rows + [(1000, 7, None, "v")]


def test_latest_earlier_row(spark, moments):
    df = spark.createDataFrame(moments, "id int, who int, at timestamp_ntz, kind string")
    got = {r["id"]: r["seen_id"] for r in last_before(df, "who", "at", "id", "kind = 'v'", ["id"], "seen_").collect()}
    want = {}
    for i, who, at, _ in moments:
        if at is not None:
            earlier = [(a, j) for j, w, a, k in moments if w == who and k == "v" and a is not None and (a, j) < (at, i)]
            want[i] = max(earlier)[1] if earlier else None
    assert got == want


@pytest.mark.parametrize("unit", ["day", "hour", "month"])
def test_sessions_across_spans(spark, moments, unit):
    df = spark.createDataFrame(moments, "id int, who int, at timestamp_ntz, kind string")
    got = {tuple(r) for r in sessions(df, "who", "at", 3600, unit).collect()}
    want = set()
    for key in {w for _, w, a, _ in moments if a}:
        runs = []
        for at in sorted(a for _, w, a, _ in moments if w == key and a):
            if runs and at - runs[-1][-1] <= timedelta(seconds=3600):
                runs[-1].append(at)
            else:
                runs.append([at])
        want |= {(key, n, run[0], run[-1], len(run)) for n, run in enumerate(runs, 1)}
    assert got == want
