"""Operator 13: repeated word windows, found by level-wise doubling.

Windows of ``length`` words that repeat can only stand where shorter ones do.
The first level looks at short windows: each window of full length is stood
for by the short window of least hash inside it, so about one place in eight
takes part. Those that occur once in the corpus are done with. The others
alone are extended to twice their length (to the right, or to the left where
they would leave the full window), are counted again, and so on, until no
candidates survive or the full length is reached. There every surviving place
is compared, and all but the first occurrence of a window are repeats.

Equal full windows have equal short windows at equal places, so no level
loses one; a hash collision at a lower level only lets a candidate live on.
Full windows are told apart by 128 bits.

Texts are never shuffled. They are written once with a row id that names the
part they lie in; what a level finds is shuffled back to the parts and read
beside them. A window that a task has met before is settled in the task: at
most two rows of one window leave a task (its first place, and one notice
that there are more), so a passage in a third of all rows is dealt like any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import (_BYTE, _table, as_long, load, materialise, mix64, only, open_fs, powers, scratch,
                                  window_hash)

LENGTH, START = 20, 5
PART_BITS = 33  # of monotonically_increasing_id
BATCH_BYTES = 1 << 20
SEEN = 1 << 20
HELD = 1 << 19

_U = np.uint64
_BYTE2 = _table(256, 91)


# --- words and window hashes of a batch of texts -----------------------------------

def batches_by_bytes(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``limit`` bytes; a longer
    text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.diff(_offsets(batch.column("text"))))
        cuts = [0, *(np.flatnonzero(np.diff(size // limit)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def _offsets(text: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], kind)[text.offset:text.offset + len(text) + 1].astype(np.int64)


class Words:
    """The words of a batch of texts: for each its row (``doc``) and its place
    in the row (``pos``), and the hashes of the windows that start there."""

    def __init__(self, text: pa.Array, second: bool = False):
        offsets = _offsets(text)
        buffer = text.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        opens, closes = word.copy(), word.copy()
        if len(data):
            inner = np.zeros(len(data) + 1, bool)  # True: no text begins here
            inner[:] = True
            inner[offsets] = False
            opens[1:] &= ~(word[:-1] & inner[1:-1])
            closes[:-1] &= ~(word[1:] & inner[1:-1])
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.doc = np.searchsorted(offsets, start, "right") - 1
        first = np.searchsorted(self.doc, np.arange(len(text)))
        self.pos = np.arange(len(start)) - first[self.doc] if len(start) else np.zeros(0, np.int64)
        self.n = len(start)
        self.lanes = [self._word_hashes(data, start, end, t) for t in ((_BYTE, _BYTE2) if second else (_BYTE,))]

    @staticmethod
    def _word_hashes(data, start, end, table) -> dict[int, np.ndarray]:
        prefix = np.zeros(len(data) + 1, _U)
        np.cumsum(table[data] * powers(len(data))[0][:len(data)], out=prefix[1:])
        return {1: window_hash(prefix, start, end)}

    def windows(self, length: int, lane: int = 0) -> np.ndarray:
        """Hashes of the windows of ``length`` words from each place on that
        has as many words after it in the batch (whatever the row), made of the
        hashes of their halves."""
        known = self.lanes[lane]
        if length not in known:
            a = length - length // 2
            left, right = self.windows(a, lane), self.windows(length // 2, lane)
            n = max(0, self.n - length + 1)
            known[length] = mix64(left[:n] * _U(0x9E3779B97F4A7C15) + mix64(right[a:a + n] + _U(length)))
        return known[length]

    def whole(self, length: int) -> np.ndarray:
        """Places whose window of ``length`` words lies within one row."""
        n = max(0, self.n - length + 1)
        return np.flatnonzero(self.doc[:n] == self.doc[length - 1:length - 1 + n])


def levels(length: int, start: int) -> list[int]:
    out = [length]
    while out[0] % 2 == 0 and out[0] // 2 >= start:
        out.insert(0, out[0] // 2)
    return out


def _lightest(h: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of least hash among the ``width`` ones from it on; of equals the first."""
    key = (h & ~_U(0xFFFFFFFF)) | np.arange(len(h), dtype=_U)
    span, low = 1, key
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    return (low & _U(0xFFFFFFFF)).astype(np.int64)


def stand_ins(words: Words, whole: np.ndarray, length: int, start: int, level: int) -> np.ndarray:
    """For each full window (by its first place, ``whole``) the first place of
    the shorter window that stands for it at ``level``. It depends on the
    window's own words alone."""
    steps = levels(length, start)
    at = (_lightest(words.windows(steps[0]), length - steps[0] + 1)[whole] if len(whole) else whole)
    for size in steps:
        if size == level:
            return at
        right = at + 2 * size <= whole + length
        at = np.where(right, at, np.maximum(whole, at - size))
    raise ValueError(level)


# --- what a level found, beside the texts --------------------------------------------

class Beside:
    """row id -> places, of the part that was asked for last."""

    def __init__(self, folder: str | None):
        self.folder, self.part, self.found = folder, None, {}

    def places(self, rid: int) -> np.ndarray:
        part = rid >> PART_BITS
        if part != self.part:
            fs, root = open_fs(f"{self.folder}/part={part}")
            self.part, self.found = part, {}
            from pyarrow import fs as pafs
            for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if info.path.endswith(".parquet"):
                    with fs.open_input_file(info.path) as f:
                        t = pq.read_table(f, columns=["rid", "places"])
                    rows, flat = t["rid"].to_numpy(), t["places"].combine_chunks()
                    offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy()
                    self.found.update((r, values[lo:hi]) for r, lo, hi in zip(rows.tolist(), offsets, offsets[1:]))
        return self.found.get(rid, _NONE)


_NONE = np.zeros(0, np.int32)


def _write_beside(found: DataFrame, label: str) -> str:
    """``found`` (rid, places) to one folder per part of the texts."""
    path = scratch(found.sparkSession, label)
    part = F.shiftright("rid", PART_BITS).alias("part")
    found.select("*", part).repartition("part").write.partitionBy("part").parquet(path)
    return path


def _still(words: Words, batch: pa.RecordBatch, length: int, start: int, level: int, beside: Beside) -> np.ndarray:
    """The full windows whose stand-in at ``level`` was found to repeat."""
    whole = words.whole(length)
    at = stand_ins(words, whole, length, start, level)
    lives = np.zeros(words.n, bool)
    first = np.searchsorted(words.doc, np.arange(batch.num_rows))
    for i, rid in enumerate(batch.column("rid").to_pylist()):
        places = beside.places(rid)
        if len(places):
            lives[first[i] + places] = True
    return whole[lives[at]]


# --- levels ----------------------------------------------------------------------------

class _Met:
    """Hashes met in a task: ``seen`` had a row sent, ``told`` a notice too.
    It forgets when it is full, which only sends more rows."""

    def __init__(self):
        self.seen = self.told = np.zeros(0, _U)

    @staticmethod
    def _has(known: np.ndarray, h: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(h), bool)
        return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h

    def sort_out(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known to repeat, per place; hashes to send a notice of)."""
        u, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        again = self._has(self.seen, u)
        many = again | (count > 1)
        notice = u[many & ~self._has(self.told, u)]
        if len(self.seen) > SEEN:
            self.seen = self.told = np.zeros(0, _U)
        self.seen = np.union1d(self.seen, u)
        self.told = np.union1d(self.told, notice)
        return many[inverse], notice


def _level_rows(length: int, start: int, level: int, last: int | None, folder: str | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, beside = _Met(), Beside(folder)
        for batch in batches_by_bytes(batches):
            words = Words(batch.column("text"))
            still = (words.whole(length) if last is None
                     else _still(words, batch, length, start, last, beside))
            at = np.unique(stand_ins(words, still, length, start, level))
            if not len(at):
                continue
            h = words.windows(level)[at]
            repeats, notice = met.sort_out(h)
            rid = batch.column("rid").to_numpy()[words.doc[at]]
            pos = words.pos[at]
            # a place known to repeat needs no company: a hash of its own, counted twice
            own = mix64(rid.astype(_U) * _U(0x9E3779B97F4A7C15) + pos.astype(_U))
            n = len(notice)
            yield pa.RecordBatch.from_arrays([
                pa.array(as_long(np.concatenate((np.where(repeats, own, h), notice)))),
                pa.array(np.concatenate((rid, np.full(n, -1)))),
                pa.array(np.concatenate((pos, np.zeros(n, np.int64))).astype(np.int32)),
                pa.array(np.concatenate((repeats + 1, np.ones(n, np.int64))).astype(np.int32))],
                ["h", "rid", "pos", "n"])
    return rows


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("rid").agg(F.collect_list("pos").alias("places"))


def _full_rows(length: int, start: int, last: int | None, folder: str | None):
    """Rows of the surviving full windows: of those that a task holds at once
    only the first leaves it, the others come as a list per row id."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside, held, size = Beside(folder), [], 0
        for batch in batches_by_bytes(batches):
            words = Words(batch.column("text"), second=True)
            at = (words.whole(length) if last is None
                  else _still(words, batch, length, start, last, beside))
            if not len(at):
                continue
            doc = words.doc[at]
            ids = batch.column("doc_id")
            held.append((words.windows(length)[at], words.windows(length, 1)[at],
                         ids.is_valid().to_numpy(zero_copy_only=False)[doc], ids.fill_null(0).to_numpy()[doc],
                         words.pos[at], batch.column("rid").to_numpy()[doc]))
            size += len(at)
            if size >= HELD:
                yield from _first_of(held)
                held, size = [], 0
        if held:
            yield from _first_of(held)
    return rows


def _first_of(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    a, b, given, doc, pos, rid = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((rid, pos, doc, given, b, a))
    a, b, given, doc, pos, rid = (c[order] for c in (a, b, given, doc, pos, rid))
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    yield _full_batch(as_long(a[first]), as_long(b[first]), given[first], doc[first], pos[first], rid[first], None)
    rest, at = rid[~first], pos[~first]
    if len(rest):
        order = np.lexsort((at, rest))
        rest, at = rest[order], at[order]
        cuts = np.flatnonzero(np.concatenate(([True], rest[1:] != rest[:-1])))
        lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(rest)).astype(np.int32)),
                                         pa.array(at.astype(np.int32)))
        rows = rest[cuts]
        none = np.zeros(len(rows), np.int64)
        yield _full_batch(as_long(mix64(rows.astype(_U))), none, none.astype(bool), none, none - 1, rows, lists)


def _full_batch(a, b, given, doc, pos, rid, known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(a), pa.array(b), pa.array(doc, pa.int64(), mask=~given), pa.array(pos.astype(np.int32)), pa.array(rid),
        pa.nulls(len(a), pa.list_(pa.int32())) if known is None else known],
        ["a", "b", "doc_id", "pos", "rid", "known"])


def repeated_windows(texts: DataFrame, length: int = LENGTH, start: int = START) -> str:
    """The folder (one subfolder per part) of rid and ``places``: where in a
    row's words a window of ``length`` words starts that also starts earlier.

    ``texts``: a written table of rid, doc_id, text (not null). Earlier is a
    smaller doc_id (null the smallest) or an earlier place in the same doc_id.
    Rows that share a doc_id count as one document; where they hold the same
    window at the same place, the row written first has it first.
    """
    steps, folder, last = levels(length, start), None, None
    for level in steps[:-1]:
        rows = texts.select("rid", "text").mapInArrow(
            _level_rows(length, start, level, last, folder), "h long, rid long, pos int, n int")
        count = F.sum("n").over(Window.partitionBy("h"))
        alive = rows.withColumn("__n", count).where("__n > 1 AND rid >= 0")
        folder, last = _write_beside(_grouped(alive), f"repeats-{level}"), level
    rows = texts.select("rid", "doc_id", "text").mapInArrow(
        _full_rows(length, start, last, folder), "a long, b long, doc_id long, pos int, rid long, known array<int>")
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("doc_id", "pos", "rid"))
    again = rows.withColumn("__place", place).where("__place > 1 OR pos < 0")
    found = again.groupBy("rid").agg(F.collect_list(F.when(F.col("pos") >= 0, F.col("pos"))).alias("single"),
                                     F.flatten(F.collect_list("known")).alias("known"))
    return _write_beside(found.select("rid", F.concat("single", "known").alias("places")), "repeats-found")


def without_repeats(docs: DataFrame, length: int = LENGTH, start: int = START) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``, the words joined by one space
    of every document without its repeated windows."""
    texts = materialise(only(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text")), "repeats-texts")
    folder = repeated_windows(texts, length, start)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = Beside(folder)
        for batch in batches_by_bytes(batches):
            n_words, n_removed, kept = [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                words = text.encode().split()  # bytes split at 0x20 and 0x09 to 0x0D alone
                places = beside.places(rid)
                n_words.append(len(words))
                if len(places):
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, places, 1)
                    np.add.at(edge, places + length, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    words = list(compress(words, stays.tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    return texts.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op13_doubling_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that a 20-word window covers which
    starts earlier too. A null, empty or blank text has no words; a text of
    under 20 words has no window and stays whole; a null doc_id counts as
    smaller than any other. An empty table gives no rows."""
    kept = without_repeats(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# The same by joins of all windows, for tables small enough.
ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM d),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s:s + 19], ' ')
                                           ORDER BY doc_id NULLS FIRST, s) AS place FROM w),
gone AS (SELECT DISTINCT doc_id, s + k AS pos FROM (SELECT doc_id, s, unnest(range(20)) AS k FROM r WHERE place > 1)),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
k AS (SELECT p.doc_id, count(*) AS n_kept, string_agg(p.word, ' ' ORDER BY p.pos) AS kept
      FROM p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos WHERE g.pos IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
