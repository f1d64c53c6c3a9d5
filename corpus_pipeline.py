"""Corpus pipeline: five stages, each an operator of ``lakeproof.llm`` on all
that its predecessor kept.

A null text passes every filter (it is no copy, holds no passage, and is
judged by its metadata alone) and is packed as an end mark. Rows without
doc_id stay, in no group of copies. Rows that share a doc_id stay or go
together where a stage decides by doc_id. Columns beside those of
``documents`` are left out at the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import PART_BYTES, bounded_batches, load, materialise, merged, only, scratch
from lakeproof.llm.decontaminate import decontaminated
from lakeproof.llm.neardup import near_duplicates
from lakeproof.llm.packing import pack_documents
from lakeproof.llm.privacy import sanitised, with_spans
from lakeproof.llm.quality import accepted, train
from lakeproof.llm.words import small
from lakeproof.session import input_bytes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SIMILARITY = 80  # percent, over shingles of five words


def parts(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """``kept`` in no more parts than two a core or the bytes of ``docs`` ask
    for: each part is a file, and a split of the stages that follow."""
    cores = kept.sparkSession.sparkContext.defaultParallelism
    return kept.coalesce(min(max(cores * 2, input_bytes(docs) // PART_BYTES), 2 ** 31 - 1))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents judged of low quality or toxic go."""
    bounded_batches(spark)
    docs = only(docs, *COLUMNS)
    return parts(accepted(docs, train(docs, load(spark, sf_dir, "labels"))), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near copies (similarity 0.8 or more) the
    smallest doc_id stays."""
    bounded_batches(spark)
    docs = only(docs, *COLUMNS)
    gone = near_duplicates(docs, SIMILARITY).where("NOT kept").select("doc_id").distinct()
    gone = materialise(merged(gone), "near-copies")
    return parts(docs.join(small(gone), "doc_id", "left_anti").select(*COLUMNS), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with a benchmark passage go."""
    bounded_batches(spark)
    docs = only(docs, *COLUMNS)
    kept = decontaminated(docs, load(spark, sf_dir, "benchmark")).where("NOT contaminated")
    return parts(kept.select(*COLUMNS), docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data and the terms that disclose it are replaced
    by their kind in brackets; n_chars follows the new text."""
    bounded_batches(spark)
    docs = only(docs, *COLUMNS)
    found = with_spans(docs).withColumn("text", sanitised())
    found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars"))).select(*COLUMNS)
    return parts(found, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the token sequences of the final corpus."""
    bounded_batches(spark)
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("PII", pii), ("best-fit packing", packing)]

# Model scores, token ids and greedy packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is written to shared
    scratch as Parquet and read again as the next stage's documents."""
    docs = only(load(spark, sf_dir, "documents"), *COLUMNS)
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
