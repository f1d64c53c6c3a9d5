"""Bronze and Silver fed by a stream of files, one micro-batch at a time.

A micro-batch writes its rows under ``<table>/batch_id=<n>`` of every table,
overwriting what an interrupted try left there, and its row in ``progress``
last; so a replayed batch or a restart adds nothing.

The watermark of a batch is the latest event time of the batches before it,
less ``delay_seconds``. It bounds the dedup state: a copy of an on-time row can
only stand in Bronze batches that reach the watermark, and only these are read.
Rows that can't be held to it go whole, with their reason, to ``aside``: late
ones, ones without an event time, and ones from the future, which would push
the watermark past all others. Every row is in Bronze, a copy of a row there,
or aside; ``progress`` has the counts.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.contract import TX_CONTRACT, Contract
from lakeproof.functions.casts import coerce
from lakeproof.operators.shape import dedup_exact
from lakeproof.plans.jobs import silver_job
from lakeproof.plans.silver import resolve_as_of
from lakeproof.sources.readers import read_layer
from lakeproof.sources.writers import write_layer

REASON = "aside_reason"
LATE, NO_TIME, FUTURE = "late", "no event time", "event time in the future"
PROGRESS = ("batch_id long, n_in long, n_aside long, n_new long, n_copies long, max_time timestamp_ntz, "
            "watermark timestamp_ntz")
_AT = "__event_time"


def read_table(spark: SparkSession, base: str, table: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """``bronze``, ``silver``, ``quarantine``, ``aside`` or ``progress`` with the
    ``batch_id`` of its rows; None while no batch has written to it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(f"{base}/{table}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _instant(value) -> F.Column:
    return F.lit(None if value is None else str(value)).cast("timestamp_ntz")


def _known(spark: SparkSession, base: str, n: int, delay_seconds: int):
    """(watermark, Bronze batches that reach it) from the batches before ``n``."""
    history = read_table(spark, base, "progress", PROGRESS)
    if history is None:
        return None, []
    if n == 0 and history.where("batch_id > 0").limit(1).count():
        raise ValueError(f"{base} holds later batches: its checkpoint is gone, or another one was given")
    before = history.where(F.col("batch_id") < n)
    latest = before.agg(F.max("max_time")).first()[0]
    if latest is None:
        return None, []
    watermark = latest - timedelta(seconds=delay_seconds)
    live = before.where((F.col("max_time") >= _instant(watermark)) & (F.col("n_new") > 0))
    return watermark, [r[0] for r in live.select("batch_id").collect()]


def take_batch(rows: DataFrame, n: int, base: str, event_time: str, delay_seconds: int,
               contract: Contract = TX_CONTRACT, as_of=None) -> None:
    """Batch ``n`` into all tables. Copies are told as in ``dedup_exact``."""
    spark, now = rows.sparkSession, resolve_as_of(as_of)

    def folder(table: str) -> str:
        return f"{base}/{table}/batch_id={n}"

    watermark, live = _known(spark, base, n, delay_seconds)
    at = F.col(_AT)
    reason = F.when(at.isNull(), NO_TIME).when(at > _instant(now), FUTURE).when(at < _instant(watermark), LATE)
    marked = rows.withColumn(_AT, coerce(rows, event_time, "timestamp_ntz")).withColumn(REASON, reason)
    on_time = F.col(REASON).isNull()
    counts = marked.agg(F.count(F.lit(1)).alias("n_in"), F.count(REASON).alias("n_aside"),
                        F.max(F.when(on_time, at)).alias("max_time")).first()
    write_layer(marked.where(~on_time).drop(_AT), folder("aside"))
    fresh = dedup_exact(marked.where(on_time).drop(_AT, REASON), contract)
    if live:
        state = spark.read.schema(fresh.schema).parquet(*[f"{base}/bronze/batch_id={i}" for i in live])
        state = state.where(coerce(state, event_time, "timestamp_ntz") >= _instant(watermark)).alias("known")
        same = [F.col(f"new.`{c}`").eqNullSafe(F.col(f"known.`{c}`")) for c in fresh.columns]
        fresh = fresh.alias("new").join(state, same, "left_anti")
    write_layer(fresh, folder("bronze"))
    n_new = read_layer(spark, folder("bronze")).count()
    if n_new:
        silver_job(spark, folder("bronze"), folder("silver"), folder("quarantine"), f"{base}/reports", contract, now,
                   batch_id=f"stream_{n:012d}", profiles_path=f"{base}/profiles")
    n_in, n_aside = counts["n_in"], counts["n_aside"]
    write_layer(spark.range(1).select(
        *[F.lit(v).cast("long").alias(c) for c, v in (("n_in", n_in), ("n_aside", n_aside), ("n_new", n_new),
                                                      ("n_copies", n_in - n_aside - n_new))],
        _instant(counts["max_time"]).alias("max_time"), _instant(watermark).alias("watermark")), folder("progress"))


def stream_medallion(spark: SparkSession, landing: str, base: str, schema: str | T.StructType, event_time: str,
                     delay_seconds: int, checkpoint: str, contract: Contract = TX_CONTRACT, as_of=None,
                     file_format: str = "parquet", files_per_batch: int | None = None, **options) -> None:
    """All files of ``landing`` that earlier runs have not taken, then stop.

    ``checkpoint`` belongs to ``base`` and is required: it says which files
    were taken. ``files_per_batch`` bounds a micro-batch; else a run is one.
    A file without rows makes a batch of none. ``as_of`` (default: each batch's own start)
    is the present of the rules and of what counts as the future.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.load(landing).writeStream
             .foreachBatch(lambda rows, n: take_batch(rows, n, base, event_time, delay_seconds, contract, as_of))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
