"""Bronze and Silver from a file stream against one batch run."""

from collections import Counter

import pytest

from lakeproof.contract import Contract, Rule
from lakeproof.plans.silver import plan_silver
from lakeproof.sources.readers import read_reports
from lakeproof.streaming.medallion import read_table, stream_medallion, take_batch

SCHEMA = "at string, who string, amount string"
CONTRACT = Contract(name="t", expected=["at", "who", "amount"], required=["at", "who", "amount"],
                    types={"at": "timestamp_ntz", "amount": "double"},
                    rules=[Rule("amount", "positive", {}, "hard", "bad amount"), Rule("at", "not_null", {}, "hard", "no time")],
                    categorical=["who"], numeric_profile=["amount"])
AS_OF = "2024-06-01 00:00:00"
DAY = 86_400


class Lake:
    def __init__(self, spark, tmp_path):
        self.spark, self.landing, self.base = spark, tmp_path / "landing", str(tmp_path / "lake")
        self.landing.mkdir()
        self.checkpoint, self.n = str(tmp_path / "checkpoint"), 0

    def deliver(self, *rows):
        (self.landing / f"f{self.n}.csv").write_text("".join(f"{','.join(r)}\n" for r in rows))
        self.n += 1

    def run(self, **kw):
        stream_medallion(self.spark, str(self.landing), self.base, SCHEMA, "at", DAY, self.checkpoint, CONTRACT, AS_OF,
                         file_format="csv", **kw)

    def rows(self, table):
        df = read_table(self.spark, self.base, table)
        return Counter() if df is None else Counter(tuple(r) for r in df.drop("batch_id").collect())

    def progress(self):
        return [tuple(r) for r in read_table(self.spark, self.base, "progress").orderBy("batch_id").select(
            "n_in", "n_aside", "n_new", "n_copies").collect()]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


FIRST = [("2024-01-01 10:00:00", "a", "1"), ("2024-01-05 10:00:00", "a", "2"), ("2024-01-05 10:00:00", "a", "2.0"),
         ("2024-01-05 11:00:00", "b", "-3")]
SECOND = [("2024-01-05 10:00:00", "a", "2.00"), ("2024-01-05 12:00:00", "", "4"), ("2024-01-06 10:00:00", "c", "5")]


def test_two_runs_equal_one_batch_and_a_restart_adds_nothing(spark, lake):
    lake.deliver(*FIRST)
    lake.run()
    lake.deliver(*SECOND)
    lake.run()
    batch = spark.createDataFrame([tuple(v or None for v in r) for r in FIRST + SECOND], SCHEMA)
    plan = plan_silver(batch, CONTRACT, AS_OF)
    want = [Counter(tuple(r) for r in df.collect()) for df in (plan.valid(), plan.quarantine())]
    for _ in range(2):
        assert [lake.rows("silver"), lake.rows("quarantine")] == want
        assert lake.progress() == [(4, 0, 3, 1), (3, 0, 2, 1)]
        assert not lake.rows("aside")
        lake.run()
    assert read_reports(spark, f"{lake.base}/reports").count() == 2


def test_late_timeless_and_future_rows_are_kept_apart(lake):
    lake.deliver(*FIRST)
    lake.run()
    odd = [("2024-01-01 10:00:00", "a", "1"), ("2024-01-04 10:59:59", "d", "9"), ("never", "d", "9"), ("", "d", "9"),
           ("2100-01-01 00:00:00", "d", "9")]
    lake.deliver(*odd, ("2024-01-04 11:00:00", "d", "9"))  # the last one stands on the watermark
    lake.run()
    reasons = ["late", "late", "no event time", "no event time", "event time in the future"]
    assert lake.rows("aside") == Counter((*(v or None for v in r), why) for r, why in zip(odd, reasons))
    assert lake.progress()[1] == (6, 5, 1, 0)
    lake.deliver(("2024-01-05 09:00:00", "e", "1"))  # the future row moved no watermark
    lake.run()
    assert lake.progress()[2] == (1, 0, 1, 0)


def test_files_in_small_batches_and_a_replayed_batch(spark, lake):
    for r in (*FIRST, *SECOND):
        lake.deliver(r)
    lake.run(files_per_batch=2)
    tables = ("bronze", "silver", "quarantine", "aside", "progress")
    before = {t: lake.rows(t) for t in tables}
    assert sum(n for *_, n, _ in lake.progress()) == 5 and len(lake.progress()) == 4
    again = read_table(spark, lake.base, "bronze").where("batch_id = 1").drop("batch_id").collect()
    take_batch(spark.createDataFrame(again, SCHEMA), 1, lake.base, "at", DAY, CONTRACT, AS_OF)
    assert {t: lake.rows(t) for t in tables if t != "progress"} == {t: r for t, r in before.items() if t != "progress"}


def test_a_batch_of_copies_and_an_empty_one(spark, lake):
    lake.deliver(*FIRST)
    lake.run()
    lake.deliver(*FIRST[1:])
    lake.run()
    lake.deliver()
    lake.run()
    assert lake.progress()[:2] == [(4, 0, 3, 1), (3, 0, 0, 3)]
    assert all(p == (0, 0, 0, 0) for p in lake.progress()[2:])


def test_a_lost_checkpoint_is_refused(spark, lake, tmp_path):
    lake.deliver(*FIRST)
    lake.run()
    lake.deliver(*SECOND)
    lake.run()
    lake.checkpoint = str(tmp_path / "other")
    with pytest.raises(Exception, match="checkpoint is gone"):
        lake.run()
    lake.checkpoint = ""
    with pytest.raises(ValueError, match="needs a checkpoint"):
        lake.run()
