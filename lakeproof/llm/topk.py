"""Operator 3: exact top-k search over a bit-sliced index.

Rows are numbered by (dimension, vec_id) and cut into blocks. A block keeps,
for every attribute, one bitmap per bit of its (shifted, so non-negative)
quantised value. Blocks are sliced once; their slices, a row for each
attribute, go to the tasks that search them, each with many queries. A query's
scores over a block are added up with bitmap arithmetic alone: carry-save
adders combine the slices of equal weight until one slice per bit of the score
is left. The best rows are then picked from the most significant slice
downward, and ties at the boundary are resolved in vec_id order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import load, materialise, only
from lakeproof.llm.sharding import number_rows

SCALE, TOP_K, EVERY = 64, 20, 20
BLOCK_ROWS = 32_768
QUERY_GROUP = 512
#: Bytes of the raw values of a block, and of the queries that a task holds at once.
BLOCK_BYTES = LANE_BYTES = 16 << 20
UNITS_PER_CORE = 16
#: In place of an attribute: the rows' vec_ids and numbers.
IDS, NUMBERS = -1, -2


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim and q, the components times ``scale`` rounded down; vectors
    that are null or hold null or non-finite components take no part."""
    ok = F.expr("embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) "
                "OR abs(cast(x AS double)) = double('Infinity'))")
    return only(vectors, "vec_id", "embedding").where(ok & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"),
        F.expr(f"transform(embedding, x -> cast(floor({scale} * cast(x AS double)) AS long))").alias("q"))


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """Booleans as uint64 words, first row in the lowest bit."""
    packed = np.packbits(bits, bitorder="little")
    return np.pad(packed, (0, -len(packed) % 8)).view("<u8")


def _rows(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    at, bit = np.nonzero(np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return words[at] * 64 + bit


def sliced(column: np.ndarray) -> tuple[int, np.ndarray]:
    """The least value, and a bitmap (a row) for each bit of the others less it, lowest first."""
    low = column.min() if len(column) else np.int64(0)
    rest = column - low
    bits = int(rest.max()).bit_length() if len(column) else 0
    out = np.empty((bits, -(-len(column) // 64)), "<u8")
    for b in range(bits):
        out[b] = _bitmap((rest >> b & 1).astype(bool))
    return int(low), out


class SlicedBlock:
    """Bit slices of a block's attributes. maps[first[d]:][:width[d]] holds the
    bits of x_d - low[d], lowest first; a negative factor uses the complement,
    the bits of (2**width[d] - 1) - (x_d - low[d]), ``flip`` rows behind them."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self._keep(ids, [sliced(column) for column in values.T])

    def _keep(self, ids: np.ndarray, attributes: list[tuple[int, np.ndarray]]) -> None:
        self.ids, self.n = ids, len(ids)
        self.all = _bitmap(np.ones(self.n, bool))
        self.low = [low for low, _ in attributes]
        self.width = [len(bits) for _, bits in attributes]
        self.first = np.cumsum([0, *self.width]).tolist()
        self.flip = self.first[-1]
        self.maps = np.empty((2 * self.flip, len(self.all)), "<u8")
        for at, (_, bits) in zip(self.first, attributes):
            self.maps[at:at + len(bits)] = bits
        np.bitwise_xor(self.maps[:self.flip], self.all, out=self.maps[self.flip:])
        self.work = [self.maps[:0]] * 2

    @classmethod
    def stored(cls, ids: np.ndarray, attributes: list[tuple[int, bytes]]) -> SlicedBlock:
        """From each attribute's least value and the bytes of its slices."""
        block, words = cls.__new__(cls), -(-len(ids) // 64)
        block._keep(ids, [(low, np.frombuffer(bits, "<u8").reshape(-1, words)) for low, bits in attributes])
        return block

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of the score less a constant, lowest first, that constant)."""
        columns: list[list[int]] = [[] for _ in range(130)]
        base = 0
        for d, factor in enumerate(query.tolist()):
            if not factor:
                continue
            base += factor * self.low[d]
            at = self.first[d]
            if factor < 0:
                base += factor * ((1 << self.width[d]) - 1)
                factor, at = -factor, at + self.flip
            for shift in range(factor.bit_length()):
                if factor >> shift & 1:
                    for b in range(self.width[d]):
                        columns[shift + b].append(at + b)
        while columns and not columns[-1]:
            columns.pop()
        # the slices of a weight stand in one array, its carries first; those it makes begin the other
        (here, there), carries, out = self.work, 0, []
        while len(out) < len(columns) or carries:
            own = columns[len(out)] if len(out) < len(columns) else []
            n = carries + len(own)
            if len(here) < n:
                here = np.concatenate([here[:carries], np.empty((2 * n - carries, len(self.all)), "<u8")])
            if len(there) < n // 2:
                there = np.empty((n, len(self.all)), "<u8")
            if own:
                np.take(self.maps, own, axis=0, out=here[carries:n], mode="clip")
            column, carries = here[:n], 0
            while (third := len(column) // 3):  # three slices of a weight make a sum and a carry
                a, b, c = column[:third], column[third:2 * third], column[2 * third:3 * third]
                carry = there[carries:carries + third]
                np.bitwise_and(a, b, out=carry)
                a ^= b
                np.bitwise_and(a, c, out=b)
                carry |= b
                c ^= a
                carries += third
                column = column[2 * third:]
            if len(column) == 2:
                np.bitwise_and(column[0], column[1], out=there[carries])
                column[1] ^= column[0]
                carries += 1
            out.append(column[-1].copy() if n else np.zeros_like(self.all))
            here, there = there, here
        self.work = [here, there]
        return np.array(out, "<u8").reshape(len(out), len(self.all)), base

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows but ``own`` (-1: none)."""
        slices, base = self.scores(query)
        sure, equal = np.zeros_like(self.all), self.all.copy()
        if own >= 0:
            equal[own >> 6] &= ~np.uint64(1 << (own & 63))
        for bits in slices[::-1]:
            ones = equal & bits
            both = sure | ones
            n = int(np.bitwise_count(both).sum())
            if n > k:
                equal = ones
            else:
                sure = both
                equal &= ~bits
                if n == k:
                    equal = np.zeros_like(equal)
                    break
        best = _rows(sure)
        rows = np.concatenate([best, _rows(equal)[:k - len(best)]])
        bits = slices[:, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
        score = base + (bits.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0)
        return rows, score


def slice_index(vectors: DataFrame) -> DataFrame:
    """dim, block, attr, low and bits: a row for each attribute of a block, and
    two for the vec_ids and numbers of its rows. ``vectors`` has a column block."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        dim, numbers = key[0].as_py(), rows["row_no"].to_numpy()
        order = np.argsort(numbers)
        values = _matrix(rows["q"], dim)
        parts = [(IDS, 0, rows["vec_id"].to_numpy()[order]), (NUMBERS, 0, numbers[order])]
        parts += [(d, *sliced(values[:, d][order])) for d in range(dim)]
        attr, low, bits = zip(*parts)
        n = len(parts)
        return pa.table({"dim": pa.array([dim] * n, pa.int32()), "block": pa.array([key[1].as_py()] * n, pa.int64()),
                         "attr": pa.array(attr, pa.int32()), "low": pa.array(low, pa.int64()),
                         "bits": pa.array([x.tobytes() for x in bits], pa.binary())})

    return vectors.groupBy("dim", "block").applyInArrow(build, "dim int, block long, attr int, low long, bits binary")


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy().reshape(len(lists), dim)


def search(key: tuple, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k best rows of a block (``left``, of slice_index) for each query of ``right``."""
    names = ["query_id", "q_no", "vec_id", "score"]
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], pa.int64())] * 4, names)
    dim = key[0].as_py()
    parts = {attr: (low, bits) for attr, low, bits in
             zip(*(left[c].to_pylist() for c in ("attr", "low", "bits")))}
    ids, numbers = (np.frombuffer(parts[x][1], np.int64) for x in (IDS, NUMBERS))
    block = SlicedBlock.stored(ids, [parts[d] for d in range(dim)])
    q_no = right["q_no"].to_numpy()
    own = np.searchsorted(numbers, q_no)
    own[numbers[np.minimum(own, len(numbers) - 1)] != q_no] = -1
    best = [block.top(q, k, int(at)) for q, at in zip(_matrix(right["q"], dim), own)]
    sizes = [len(rows) for rows, _ in best]
    return pa.table([np.repeat(right["query_id"].to_numpy(), sizes), np.repeat(q_no, sizes),
                     ids[np.concatenate([rows for rows, _ in best])], np.concatenate([score for _, score in best])], names)


def bit_sliced_top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP_K,
                     block_rows: int = BLOCK_ROWS, query_group: int = QUERY_GROUP) -> DataFrame:
    """query_id, rank, vec_id, score. Both sides as from ``numbered``: vec_id,
    dim, q, row_no; a query meets every row of its dimension but itself (the
    same row_no; repeated rows with other numbers are candidates). Each block is
    sliced once and sent to a few lanes, to which the queries are dealt: as many
    as the cores ask for, but no lanes of under ``query_group`` queries, or as
    many as it takes for a lane's queries to be held by a task."""
    # a block of long vectors has fewer rows
    rows = F.least(F.lit(block_rows), F.greatest(F.lit(64), F.floor(F.lit(BLOCK_BYTES // 8) / F.greatest("dim", F.lit(1)))))
    index = vectors.withColumn("block", F.floor(F.col("row_no") / rows))
    blocks = index.select("dim", "block").distinct()
    n_blocks = max(1, blocks.count())
    n_queries, longest = queries.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, min(-(-n_queries // query_group), -(-cores * UNITS_PER_CORE // n_blocks)),
                -(-n_queries * longest * 8 // LANE_BYTES))
    asked = (queries.withColumn("lane", F.pmod(F.xxhash64("row_no"), F.lit(lanes).cast("long")))
             .join(blocks.groupBy("dim").agg(F.collect_list("block").alias("blocks")), "dim")
             .select(F.col("dim").alias("q_dim"), F.explode("blocks").alias("q_block"), F.col("lane").alias("q_lane"),
                     F.col("row_no").alias("q_no"), F.col("vec_id").alias("query_id"), "q"))
    sent = slice_index(index).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")))
    # by number: the bytes of a unit, which adaptive execution would go by, don't tell its work
    units = 2 * n_blocks * lanes
    found = (sent.repartition(units, "dim", "block", "lane").groupBy("dim", "block", "lane")
             .cogroup(asked.repartition(units, "q_dim", "q_block", "q_lane").groupBy("q_dim", "q_block", "q_lane"))
             .applyInArrow(lambda key, left, right: search(key, left, right, k),
                           "query_id long, q_no long, vec_id long, score long"))
    # by query row: rows that repeat a vec_id are queries of their own
    best = Window.partitionBy("query_id", "q_no").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def numbered(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Quantised vectors with row numbers in (dim, vec_id) order, written once."""
    return materialise(number_rows(quantised(vectors, scale), ["dim", "vec_id", "q"]), "vectors")


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every vector whose vec_id is divisible by 20. An
    empty table gives no rows."""
    vectors = numbered(load(spark, sf_dir, "embeddings"))
    return bit_sliced_top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(EVERY)) == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.row_no AS q_no, b.vec_id AS vec_id,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row_no <> b.row_no WHERE a.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY q_no ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
         vec_id, score FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20
"""
