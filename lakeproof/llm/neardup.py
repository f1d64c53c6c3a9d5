"""Operator 10: MinHash near-duplicates by a signature-coordinate inverted join.

1. Every text becomes its set of five-word shingles (64-bit hashes) and a
   signature of K minima. Equal sets are one class; only classes go on.
2. A class posts itself under its first K - T + 1 (coordinate, value) pairs:
   two signatures that agree in T coordinates share one of these (prefix).
   Lists of one entry are skipped; in the others collisions are counted over
   whole signatures. A list leaves its members joined where T or more agree,
   as a forest, never as pairs.
3. Inside the groups so found, whole shingle sets decide each link exactly;
   the links' forest gives the components.

Lists and groups of any size are dealt out as pairs of bounded blocks, so
that no task holds more than two blocks of one.

T is the largest count that misses a pair exactly at the threshold with a
probability of 1e-6 at most (a closer one less): with K = 32 it is 16 at 0.85
and 13 at 0.80.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import (_table, as_long, by_bytes, load, map_frames, materialise, merged, mix64, only,
                                  prefix_hash, window_hash)

WORDS, THRESHOLD = 5, 85
COORDINATES, MISSED = 32, 1e-6
LIST_BLOCK, GROUP_BLOCK = 512, 256

_U = np.uint64
_MUL, _XOR = _table(COORDINATES, 101) | _U(1), _table(COORDINATES, 102)
_POLY = _U(0xC2B2AE3D27D4EB4F)


def matches_for(threshold: int) -> int:
    """The most coordinates that can be asked to agree: a pair of similarity
    ``threshold`` percent agrees in fewer with probability MISSED at most."""
    p, missed, t = threshold / 100, 0.0, 0
    while t < COORDINATES:
        missed += comb(COORDINATES, t) * p ** t * (1 - p) ** (COORDINATES - t)
        if missed > MISSED:
            break
        t += 1
    return max(t, 1)


def _words(data: np.ndarray, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``data``, which ends in a blank; long
    data is read in pieces that end in a blank."""
    starts, hashes, lo = [], [], 0
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    while lo < len(data):
        hi = lo + piece
        hi = len(data) if hi >= len(data) else hi + int(blank[hi:].argmax()) + 1
        part = data[lo:hi]
        part = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([1], blank[lo:hi])).astype(np.int8)))
        starts.append(edge[0::2] + lo)
        hashes.append(window_hash(prefix_hash(part), edge[0::2], edge[1::2]))
        lo = hi
    return np.concatenate(starts), np.concatenate(hashes)


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' word windows in order, bounds): text i owns
    hashes[bounds[i]:bounds[i + 1]], with repeats."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    start, word = _words(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
    first = np.concatenate(([0], np.searchsorted(start, ends)))
    count = np.diff(first)
    n = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(bounds[-1], _U)
    at = np.repeat(first[:-1] - bounds[:-1], n) + np.arange(bounds[-1])  # a window's first word
    width = np.repeat(np.minimum(count, words), n)
    for j in range(words):
        inside = j < width
        out[inside] = out[inside] * _POLY + word[at[inside] + j]
    return mix64(out + width.astype(_U)), bounds


def _encoded(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def _signature(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """K minima per text; texts must not be empty."""
    out = np.empty((len(bounds) - 1, COORDINATES), _U)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat((h ^ _XOR[k]) * _MUL[k], bounds[:-1])
    return mix64(out)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit key, and the minima."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_bytes(batches):
            texts = _encoded(batch["text"])
            h, bounds = shingles(texts)
            n, low, high = [np.zeros(len(texts), np.int64) for _ in range(3)]
            for i in range(len(texts)):
                own = np.unique(h[bounds[i]:bounds[i + 1]])
                n[i] = len(own)
                low[i] = as_long(own.sum(dtype=_U, keepdims=True))[0]
                high[i] = as_long(mix64(own ^ _U(77)).sum(dtype=_U, keepdims=True))[0]
            full = np.flatnonzero(n)
            minima = [None] * len(texts)
            if len(full):
                kept = np.append(bounds[:-1][full], bounds[-1])
                for i, m in zip(full, _signature(h, kept)):
                    minima[i] = m.tobytes()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": n,
                                "key_low": low, "key_high": high, "minima": minima})

    return map_frames(
        only(docs, "doc_id", "text"), sign, "doc_id long, n_shingles long, key_low long, key_high long, minima binary")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Frames of whole groups out of batches sorted by ``keys``."""
    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(frame) - int(last[::-1].argmin() if not last.all() else len(frame))
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        held, n = [frame.iloc[cut:]], len(frame) - cut
    if n:
        yield pd.concat(held, ignore_index=True)


def _labels(joined: np.ndarray) -> np.ndarray:
    """The smallest member reachable from each, in a symmetric relation."""
    n = len(joined)
    label = np.arange(n)
    linked = joined | np.eye(n, dtype=bool)
    while True:
        new = np.where(linked, label, n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def in_blocks(rows: DataFrame, key: str, member: str, size: str, block: int) -> DataFrame:
    """Deal the members of each ``key`` (of ``size`` rows) out to pairs of
    blocks, so that any two members meet in a pair and no pair holds much more
    than two blocks: columns __i, __j are added."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(5)), F.col("__n")).cast("int")
    return (rows.withColumn("__n", n).withColumn("__b", own)
            .withColumn("__o", F.explode(F.expr(
                "if(__n = 1, array(0), filter(sequence(0, __n - 1), x -> x <> __b))")))
            .withColumn("__i", F.least("__b", "__o")).withColumn("__j", F.greatest("__b", "__o"))
            .drop("__n", "__b", "__o"))


def _collisions(matches: int):
    def collide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Forests of the members that agree in ``matches`` coordinates or more."""
        keys = ["key", "__i", "__j"]
        for frame in whole_groups(batches, keys):
            node = frame["node"].to_numpy(np.int64)
            sig = np.frombuffer(b"".join(frame["sig"]), np.uint16).reshape(len(frame), COORDINATES)
            change = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            start = np.flatnonzero(change)
            size = np.diff(np.append(start, len(frame)))
            group = np.repeat(np.arange(len(start)), size)
            a, b = [], []
            small = size[group] <= 16
            for d in range(1, 16):  # small lists of the frame at once, by distance
                left = np.flatnonzero(small[:-d] & (group[:-d] == group[d:])) if len(frame) > d else np.zeros(0, int)
                if not len(left):
                    break
                hit = left[(sig[left] == sig[left + d]).sum(axis=1) >= matches]
                a.append(node[hit])
                b.append(node[hit + d])
            for g in np.flatnonzero(size > 16):
                own = slice(start[g], start[g] + size[g])
                s, joined = sig[own], np.zeros((size[g], size[g]), np.uint8)
                for k in range(COORDINATES):
                    joined += s[:, k, None] == s[None, :, k]
                label = _labels(joined >= matches)
                far = np.flatnonzero(label != np.arange(size[g]))
                a.append(node[own][far])
                b.append(node[own][label[far]])
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
    return collide


def _links(threshold: int):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Forests of exact links among the members of a pair of blocks."""
        keys = ["grp", "__i", "__j"]
        for frame in whole_groups(batches, keys, 512):
            change = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            for own in np.split(np.arange(len(frame)), np.flatnonzero(change)[1:]):
                if len(own) < 2:
                    continue
                node = frame["node"].to_numpy(np.int64)[own]
                sets = [np.frombuffer(frame["members"].iloc[i], _U) for i in own]
                label = _labels(exact_links(sets, threshold))
                far = np.flatnonzero(label != np.arange(len(own)))
                if len(far):
                    yield pd.DataFrame({"a": node[far], "b": node[label[far]]})
    return verify


def exact_links(sets: list[np.ndarray], threshold: int = THRESHOLD) -> np.ndarray:
    """Where 100 * intersection >= threshold * union, for all pairs of sets."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, shingle, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1  # a shingle of one set alone is in no intersection
    column = np.cumsum(common) - 1
    keep = common[shingle]
    owner, shingle = owner[keep], column[shingle[keep]]
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for lo in range(0, int(common.sum()), width):
        part = slice(*np.searchsorted(shingle, [lo, lo + width]))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[part], shingle[part] - lo] = 1
        both += matrix @ matrix.T
    both = both.astype(np.int64)
    return 100 * both >= threshold * (n[:, None] + n[None, :] - both)


def shingle_sets(members: DataFrame) -> DataFrame:
    """``members`` (with text) with the text replaced by its set, as bytes."""
    fields = [f"{n} {t}" for n, t in members.dtypes if n != "text"] + ["members binary"]
    names = [n for n in members.columns if n != "text"]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_bytes(batches):
            h, bounds = shingles(_encoded(batch["text"]))
            out = batch[names].copy()
            out["members"] = [np.unique(h[lo:hi]).tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
            yield out

    return members.mapInPandas(build, ", ".join(fields))


def _other(column: str):
    """The key in another guise. Joining an aggregate with its own input on the
    key itself would reuse the aggregate's partitioning, and Spark splits
    skewed partitions only where both sides are exchanged for the join."""
    return F.bitwise_not(column)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge: the smallest node reachable.
    Alternating large and small stars; each round is written to shared scratch,
    and the edges shrink to stars in a number of rounds that grows with the
    logarithm of the longest path. Hubs are split by the skew join."""
    def pairs(a, b):
        return F.greatest(a, b).alias("a"), F.least(a, b).alias("b")

    edges = materialise(merged(edges.where("a <> b").select(*pairs("a", "b")).distinct()), "edges")
    mark = None
    for _ in range(rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(_other("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").withColumn("k", _other("u")).join(low, "k")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        turned = (large.withColumn("k", _other("a")).join(low.select(_other("a").alias("k"), "m"), "k")
                  .where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = materialise(merged(low.select("a", F.col("m").alias("b")).union(turned).distinct()), "stars")
        new = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if mark == new:
            break
        mark = new
    else:
        raise RuntimeError("the components did not settle")
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Null, empty and blank texts have no shingles and are linked with nothing.
    A row without doc_id is linked with nothing and kept, its component null.
    Rows that share a doc_id are each judged by their own text; a link of one
    of them counts for the id. An empty table gives no rows.
    """
    matches = matches_for(threshold)
    prefix = COORDINATES - matches + 1
    signed = materialise(merged(signatures(docs), 2), "signed")
    classes = materialise(merged(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key_low", "key_high", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("minima").alias("minima"))), "classes")

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = np.frombuffer(b"".join(batch["minima"]), _U).reshape(len(batch), COORDINATES)
            keys = mix64(m[:, :prefix] ^ _table(prefix, 103)[None, :])
            yield pd.DataFrame({"node": np.repeat(batch["node"].to_numpy(), prefix), "key": as_long(keys.ravel())})

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = np.frombuffer(b"".join(batch["minima"]), _U).reshape(len(batch), COORDINATES).astype(np.uint16)
            yield pd.DataFrame({"node": batch["node"], "sig": [row.tobytes() for row in m]})

    postings = classes.select("node", "minima").mapInPandas(post, "node long, key long")
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(_other("key").alias("k"), "n")
    live = postings.withColumn("k", _other("key")).join(lists, "k").select("key", "node", "n")
    sigs = classes.select("node", "minima").mapInPandas(sketch, "node long, sig binary")
    dealt = in_blocks(live, "key", "node", "n", LIST_BLOCK).join(sigs, "node").select("key", "__i", "__j", "node", "sig")
    candidates = (dealt.repartition("key", "__i", "__j").sortWithinPartitions("key", "__i", "__j")
                  .mapInPandas(_collisions(matches), "a long, b long"))

    found = components(candidates)
    found = found.union(found.select("root", "root").distinct())
    found = materialise(merged(found), "groups")
    sizes = found.groupBy("root").agg(F.count("*").alias("n")).select(_other("root").alias("k"), "n")
    group = (found.withColumn("k", _other("root")).join(sizes, "k")
             .select("node", F.col("root").alias("grp"), "n"))
    texts = (group.join(only(docs, "doc_id", "text").dropna(subset=["doc_id"]),
                        F.col("node") == F.col("doc_id")).select("node", "grp", "n", "text"))
    dealt = in_blocks(shingle_sets(texts), "grp", "node", "n", GROUP_BLOCK)
    links = (dealt.select("grp", "__i", "__j", "node", "members").repartition("grp", "__i", "__j")
             .sortWithinPartitions("grp", "__i", "__j").mapInPandas(_links(threshold), "a long, b long"))

    linked = components(links)
    roots = classes.join(linked, "node", "left").select(
        _other("key_low").alias("k"), "key_high", "n_shingles", F.coalesce("root", "node").alias("component"))
    out = (signed.select("doc_id", "n_shingles", "key_high", _other("key_low").alias("k"))
           .join(roots, ["k", "key_high", "n_shingles"], "left")
           .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at 0.85."""
    return near_duplicates(load(spark, sf_dir, "documents"))
