"""Operator 4: sharding by a Feistel permutation with cycle walking.

Rows get global numbers 0..n-1 in a fixed order of their key; a keyed
bijection of 0..n-1 shuffles them, and a row's shard and slot follow from the
permuted number alone (``p % shards``, ``p // shards``), so any row's place
can be computed, and inverted, without looking at other rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import load, materialise, mix64, only

SEED = 20_240_601
ROUNDS = 6


def _half_bits(n: int) -> int:
    """Bits of half a block: the smallest even-width domain that holds 0..n-1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: int, seed: int, inverse: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix64(np.array([seed], np.uint64)))
    for k in (keys[::-1] if inverse else keys):
        if inverse:
            left, right = right ^ (mix64(left ^ k) & mask), left
        else:
            left, right = right, left ^ (mix64(right ^ k) & mask)
    return (left << np.uint64(half)) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (or its inverse) at ``numbers``. A number that
    leaves the range is sent round again until it comes back: the network is a
    bijection of a domain under four times n, so a walk takes four steps at
    most on average, and no two walks end alike."""
    half = _half_bits(n)
    out = _network(np.asarray(numbers, np.uint64), half, seed, inverse)
    while (away := out >= np.uint64(n)).any():
        out[away] = _network(out[away], half, seed, inverse)
    return out.astype(np.int64)


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Gapless global row numbers in ``order``, without one task that sorts all
    rows: range partitions are sorted and written once (so that they can't be
    drawn anew differently), then each adds its offset, the count of the rows
    before it. Only one count per partition meets in one place."""
    parts = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("__part").count().select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    return (parts.join(offsets, "__part")
            .withColumn(name, F.col("__before") + F.col("__place"))
            .drop("__part", "__place", "__before"))


def feistel_shards(df: DataFrame, order: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_no``, ``permuted``, ``shard`` and ``slot``.

    Shard counts differ by one at most and slots are gapless from 0. Null keys
    sort first; rows equal in ``order`` get neighbouring numbers, in any order.
    An empty table gives no rows.
    """
    numbered = number_rows(df, order)
    n = numbered.count()

    @F.pandas_udf("long")
    def permuted(x: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in x:
            yield pd.Series(permute(s.to_numpy(), n, seed))

    return (numbered.withColumn("permuted", permuted("row_no"))
            .withColumn("shard", (F.col("permuted") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("permuted") / F.lit(shards)).cast("long")))


def op4_feistel_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in shards 0..7 under the law ``rows``."""
    sized = documents_sized(load(spark, sf_dir, "documents"))
    return feistel_shards(sized, ["doc_id", "text_crc32"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no")


def documents_sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one; null text: none) and text_crc32."""
    text = F.coalesce("text", F.lit(""))
    return only(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
