"""Operator 5: best-fit packing by minimum bin slack.

Pieces of a length are interchangeable, so the search works on the histogram
of lengths (4096 entries at most, whatever the corpus): per bin, a bitset
subset-sum over the lengths still there finds the fullest combination that
holds the longest piece; it is removed as often as the counts allow. The
plan, a list of ranges of ranks, is bounded by the histogram too; each piece
then looks up its own sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import encoder, load, map_frames, materialise, only, text_parts, tokenizer_path

CAPACITY = 4096
RANK_GROUPS = 256
ROWS_PER_TASK = 250_000


def fullest(longest: int, lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest multiset of available lengths that holds ``longest`` and
    fits: bit s of a bitset tells that the sum s can be reached. Lengths are
    offered from long to short, each in binary parts of its count; the search
    ends at once when the bin is full to the brim."""
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        left = min(counts[length] - (length == longest), room // length)
        part = 1
        while left > 0:
            take = min(part, left)
            grown = (reach | reach << (take * length)) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def pack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) rows: the
    pieces of these ranks go, in order, to consecutive sequences."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(counts, 0)
    lengths = sorted(counts, reverse=True)
    plan, sequence = [], 0
    while lengths:
        chosen = fullest(lengths[0], lengths, counts, capacity)
        times = min(counts[n] // k for n, k in chosen.items())
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            for _ in range(k):
                plan.append((n, used[n], used[n] + times, sequence, offset))
                used[n] += times
                offset += n
            counts[n] -= k * times
        sequence += times
        lengths = [n for n in lengths if counts[n]]
    return plan


def token_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                 capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces."""
    path = tokenizer_path(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for part in (p for batch in batches for p in text_parts(batch)):
            ids, bounds = enc.encode_many(part.column("text"), end_id)
            n_pieces = -(-np.diff(bounds) // capacity)
            row = np.repeat(np.arange(len(n_pieces)), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            lo = bounds[row] + piece * capacity
            hi = np.minimum(lo + capacity, bounds[row + 1])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(piece * capacity),
                 pa.array(hi - lo), pa.array([zlib.crc32(ids[a:b]) for a, b in zip(lo, hi)], pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return only(docs, "doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. Ranks are counted in groups of
    a hash of the piece, so that pieces of one common length are not all in
    one task; a group's first rank is the sum of the groups' counts before it.

    A piece is a few dozen bytes, so pieces and result are written by as many
    tasks as the cores or their rows ask for, not by one for each split of the
    texts or shuffle partition.
    """
    cores = pieces.sparkSession.sparkContext.defaultParallelism
    grouped = pieces.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_GROUPS)))
    grouped = materialise(grouped.repartition(cores * 4), "pieces")
    counts = grouped.groupBy("length", "__group").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = pd.DataFrame(pack_plan(histogram, capacity), columns=["length", "first", "last", "sequence", "offset"])
    plan = plan.sort_values(["length", "first"]).to_numpy(np.int64)
    before = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "__group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    local = Window.partitionBy("length", "__group").orderBy("doc_id", "piece")
    ranked = (grouped.withColumn("__local", F.row_number().over(local) - 1).join(bases, ["length", "__group"])
              .withColumn("__rank", F.col("__base") + F.col("__local")).drop("__base", "__local", "__group"))
    # (length, first rank) as one ascending number; ranks stay under 2**48
    keys = (plan[:, 0] << 48) + plan[:, 1] if len(plan) else np.zeros(0, np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch.pop("__rank").to_numpy(np.int64)
            at = np.searchsorted(keys, (batch["length"].to_numpy(np.int64) << 48) + rank, "right") - 1
            batch["sequence_id"] = plan[at, 3] + rank - plan[at, 1]
            batch["offset"] = plan[at, 4]
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    tasks = max(cores, sum(histogram.values()) // ROWS_PER_TASK)
    return map_frames(
        ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "__rank").coalesce(tasks), place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with their sequence and offset. Null and empty
    texts are the end id alone; a null doc_id stays null; an empty table gives
    no rows; repeated rows are packed each on its own."""
    return pack(token_pieces(docs, tokenizer, capacity=capacity), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens at most."""
    return pack_documents(load(spark, sf_dir, "documents"))
