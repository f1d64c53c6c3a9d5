"""Operator 1: removal of repeated 200-byte strings by a distributed,
common-prefix-aware merge sort of suffixes.

Not all suffixes need sorting. Every window of SPAN bytes names one of its
own positions, its anchor: the first of its CORE-byte strings with the
smallest hash. Equal windows name the same position, so two equal windows
anywhere show as two anchors with equal surroundings, and it is enough to
compare suffixes that start at anchors (about one position in 70), extended to
the left as far as the anchor's windows reach.

1. Anchors are drawn from all texts; those whose core occurs once are dropped.
2. For the rest, the suffixes (SPAN bytes) with their left contexts are
   sorted where their text is, and leave as front-coded runs: of each suffix
   only what follows its common prefix with the one before.
3. Runs meet by core and are merged with a loser tree that knows common
   prefixes: a comparison starts at the longer known prefix, or is decided by
   it, so no known byte is compared again. The merge yields the common prefix
   of neighbours, from which, for each distance between a window and its
   anchor, the equal windows follow.

A core that occurs more than HOT times (a passage in a third of all
documents) would gather in one task. Its anchors go another way with the same
result: equal surroundings are counted by hash with map-side aggregation, and
what is left is settled window by window the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import as_long, by_bytes, load, map_frames, materialise, mix64, only, prefix_hash, window_hash

SPAN, CORE = 200, 64
BACK = SPAN - CORE  # a window starts at most so far before its anchor
RUN_TARGET = 40_000  # suffixes per merge partition
HOT = RUN_TARGET // 2  # a core that would fill half a partition alone
SEGMENT = 1 << 20

_U = np.uint64


# --- anchors -----------------------------------------------------------------

def anchors_of(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of texts laid end to end, text i up to ends[i]: text, at (the
    anchor's place in ``data``), first and last (of its windows' starts), core
    and extent hashes. The extent is all bytes of these windows."""
    starts = np.concatenate(([0], ends[:-1]))
    empty = {c: np.zeros(0, np.int64) for c in ("text", "at", "first", "last", "core", "extent")}
    if len(data) < SPAN:
        return empty
    prefix = prefix_hash(data)
    place = np.arange(len(data) - CORE + 1)
    core = window_hash(prefix, place, place + CORE)
    least = (core & _U(0xFFFFFFFF00000000)) | place.astype(_U)
    width, windows = 1, BACK + 1
    while 2 * width <= windows:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < windows:
        gap = windows - width
        least = np.minimum(least[:-gap], least[gap:])
    valid = np.ones(len(least), bool)
    for e in ends:  # no window runs over a text's end
        valid[max(e - SPAN + 1, 0):e] = False
    first = np.flatnonzero(valid)
    if not len(first):
        return empty
    at = (least[first] & _U(0xFFFFFFFF)).astype(np.int64)
    turn = np.flatnonzero(np.diff(at, prepend=-1))
    last = first[np.append(turn[1:], len(first)) - 1]
    at, first = at[turn], first[turn]
    extent = window_hash(prefix, first, last + SPAN) ^ mix64((at - first).astype(_U))
    return {"text": np.searchsorted(ends, at, "right"), "at": at, "first": first, "last": last,
            "core": as_long(core[at]), "extent": as_long(extent), "starts": starts}


def _segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, text numbers, offsets): short texts together, long texts
    in pieces that overlap by SPAN - 1 bytes, so that each window is in one."""
    held, numbers, size = [], [], 0
    for i, t in enumerate(texts):
        if len(t) < SPAN:
            continue
        if len(t) > SEGMENT:
            for lo in range(0, len(t) - SPAN + 1, SEGMENT):
                piece = np.frombuffer(t, np.uint8)[lo:lo + SEGMENT + SPAN - 1]
                yield piece, np.array([len(piece)]), np.array([i]), np.array([lo])
            continue
        held.append(t)
        numbers.append(i)
        size += len(t)
        if size > SEGMENT:
            yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), np.array(numbers), np.zeros(len(held), np.int64)
            held, numbers, size = [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), np.array(numbers), np.zeros(len(held), np.int64)


def _draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in by_bytes(batches):
        keys = batch["key"].to_numpy(np.int64)
        texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in batch["text"]]
        for data, ends, numbers, offsets in _segments(texts):
            a = anchors_of(data, ends)
            if not len(a["at"]):
                continue
            at = a["at"] - a["starts"][a["text"]] + offsets[a["text"]]
            yield pd.DataFrame({
                "core": a["core"], "extent": a["extent"], "key": keys[numbers[a["text"]]],
                # place and the reach of its windows in one number
                "spot": at << 16 | (a["at"] - a["first"]) << 8 | (a["at"] - a["last"])})


def _unpack(spot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """place, farthest and nearest window start before it."""
    return spot >> 16, spot >> 8 & 255, spot & 255


# --- front-coded runs and their merge ------------------------------------------

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    i, step = known, 16
    while i < n and a[i:i + step] == b[i:i + step]:
        i += step
        step *= 2
    while step > 1 and i < n:
        step //= 2
        if a[i:i + step] == b[i:i + step]:
            i += step
    return min(i, n)


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """(common prefix with the one before, the rests, rest lengths)."""
    shared = np.zeros(len(suffixes), np.uint8)
    rest, last = [], b""
    for i, s in enumerate(suffixes):
        shared[i] = common_prefix(last, s, 0)
        rest.append(s[shared[i]:])
        last = s
    return shared, b"".join(rest), np.array([len(r) for r in rest], np.uint8)


def pack_run(rows: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """A sorted run of (suffix, left context, key, spot) rows."""
    import zstandard
    rows.sort(key=lambda r: r[0])
    shared, rest, lengths = front_code([r[0] for r in rows])
    left = [r[1] for r in rows]
    body = b"".join([
        np.array([len(rows), len(rest)], "<u4").tobytes(), shared.tobytes(), lengths.tobytes(),
        np.array([len(x) for x in left], np.uint8).tobytes(),
        np.array([r[2] for r in rows], "<i8").tobytes(), np.array([r[3] for r in rows], "<i8").tobytes(),
        rest, b"".join(left)])
    return zstandard.ZstdCompressor(level=3).compress(body)


class Run:
    """A run as it is read: suffixes, their known common prefixes, the rest."""

    def __init__(self, blob: bytes):
        import zstandard
        body = zstandard.ZstdDecompressor().decompress(blob)
        n, size = np.frombuffer(body, "<u4", 2)
        n, size, at = int(n), int(size), 8
        self.shared = np.frombuffer(body, np.uint8, n, at).tolist()
        lengths = np.frombuffer(body, np.uint8, n, at + n).tolist()
        left = np.frombuffer(body, np.uint8, n, at + 2 * n).tolist()
        self.keys = np.frombuffer(body, "<i8", n, at + 3 * n)
        self.spots = np.frombuffer(body, "<i8", n, at + 11 * n)
        at += 19 * n
        self.suffixes, last = [], b""
        for shared, length in zip(self.shared, lengths):
            last = last[:shared] + body[at:at + length]
            self.suffixes.append(last)
            at += length
        self.left = []
        for length in left:
            self.left.append(body[at:at + length])
            at += length


def merge_runs(runs: list[list[bytes]], shared: list[list[int]]) -> tuple[list[tuple[int, int]], list[int]]:
    """(run, index) in sorted order, and each one's common prefix with the one
    before. A loser tree whose every head knows its common prefix with the
    last winner on its path: the head with the longer one is smaller without
    any comparison, and equal ones are compared from there on."""
    k = 1
    while k < len(runs):
        k *= 2
    index = [0] * k
    known = [0] * k
    head: list[bytes | None] = [runs[i][0] if i < len(runs) and runs[i] else None for i in range(k)]
    loser = [-1] * k

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of two heads; the loser then knows its common
        prefix with the winner."""
        hx, hy = head[x], head[y]
        if hy is None:
            return x, y
        if hx is None:
            return y, x
        kx, ky = known[x], known[y]
        if kx > ky:
            return x, y
        if ky > kx:
            return y, x
        n = common_prefix(hx, hy, kx)
        if hx[n:n + 1] < hy[n:n + 1] or (n == len(hx) == len(hy) and x < y) or (n == len(hx) < len(hy)):
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    order, prefixes = [], []
    winner = build(1) if k > 1 else 0
    while head[winner] is not None:
        order.append((winner, index[winner]))
        prefixes.append(known[winner])
        index[winner] += 1
        run = runs[winner]
        if index[winner] < len(run):
            head[winner] = run[index[winner]]
            known[winner] = shared[winner][index[winner]]
        else:
            head[winner] = None
        node = (winner + k) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2
    return order, prefixes


def equal_windows(prefixes: np.ndarray, left: list[bytes], spots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) in merged order: the bytes covered by windows of the
    row's anchor that another row has too. Windows at distance ``o`` before
    their anchors are equal where suffixes share SPAN - o bytes and left
    contexts their last o bytes. All windows of an anchor cover it, so those
    found make one span."""
    n = len(left)
    at, far, near = _unpack(spots)
    size = np.array([len(x) for x in left])
    block = np.zeros((BACK, n), np.uint8)
    flat = np.frombuffer(b"".join(left), np.uint8)
    owner = np.repeat(np.arange(n), size)
    block[np.repeat(np.cumsum(size), size) - np.arange(len(flat)) - 1, owner] = flat  # row 0: the byte before
    low, high = np.full(n, -1), np.full(n, -1)
    behind = np.zeros(n, _U)
    cores = np.cumsum(prefixes < CORE)
    alone = np.bincount(cores)[cores] < 2
    for o in range(BACK + 1):
        if o:
            behind = mix64(behind + block[o - 1].astype(_U) + _U(o))
        rows = np.flatnonzero((near <= o) & (o <= far) & ~alone)
        if len(rows) < 2:
            continue
        group = mix64(np.cumsum(prefixes < SPAN - o)[rows].astype(_U)) ^ behind[rows]
        order = np.argsort(group, kind="stable")
        same = group[order][1:] == group[order][:-1]
        hit = np.zeros(len(rows), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        hit = rows[hit]
        low[hit] = np.where(low[hit] < 0, o, low[hit])
        high[hit] = o
    rows = np.flatnonzero(high >= 0)
    return rows, at[rows] - high[rows], at[rows] - low[rows] + SPAN


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans found by merging the runs of each merge partition."""
    held: list[bytes] = []
    part = None

    def merged() -> Iterator[pd.DataFrame]:
        runs = [Run(b) for b in held]
        order, prefixes = merge_runs([r.suffixes for r in runs], [r.shared for r in runs])
        rows, start, end = equal_windows(
            np.array(prefixes), [runs[r].left[i] for r, i in order], np.array([runs[r].spots[i] for r, i in order]))
        if len(rows):
            yield pd.DataFrame({"key": [int(runs[order[i][0]].keys[order[i][1]]) for i in rows],
                                "start": start, "end": end})

    for batch in batches:
        for p, run in zip(batch["part"], batch["run"]):
            if p != part and held:
                yield from merged()
                held = []
            part = p
            held.append(run)
    if held:
        yield from merged()


# --- the operator ----------------------------------------------------------------

def _pack_text(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, key and the text as a compressed frame, for shuffles."""
    types = dict(docs.dtypes)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out = batch[[*columns, "key"]].copy()
            out["z"] = [c.compress(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"")
                        for t in batch["text"]]
            yield out

    return map_frames(docs.select(*columns, "key", "text"), pack, ", ".join(f"{c} {types[c]}" for c in columns) + (", " if columns else "") + "key long, z binary")


def _contexts(parts: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Front-coded runs of the anchors' suffixes by merge partition, and
        window hashes of the hot ones, from texts with their anchors."""
        import zstandard
        d = zstandard.ZstdDecompressor()
        held: dict[int, list] = {}
        n, last = 0, None

        def runs() -> pd.DataFrame:
            return pd.DataFrame([(p, pack_run(rows)) for p, rows in held.items()], columns=["part", "run"])

        for batch in batches:
            hot = []
            for key, z, wanted in zip(batch["key"], batch["z"], batch["wanted"]):
                if key == last:
                    continue  # another copy of the text
                last = key
                text = d.decompress(z)
                core = np.array([w["core"] for w in wanted], np.int64)
                spot = np.array([w["spot"] for w in wanted], np.int64)
                is_hot = np.array([w["hot"] for w in wanted])
                at, far, near = _unpack(spot)
                target = (mix64(core.view(_U)) % _U(parts)).astype(np.int64)
                for i in np.flatnonzero(~is_hot):
                    a = int(at[i])
                    held.setdefault(int(target[i]), []).append(
                        (text[a:a + SPAN], text[a - int(far[i]):a], int(key), int(spot[i])))
                    n += 1
                if is_hot.any():
                    lo = int((at - far)[is_hot].min())
                    prefix = prefix_hash(np.frombuffer(text, np.uint8)[lo:int((at - near)[is_hot].max()) + SPAN])
                    for i in np.flatnonzero(is_hot):
                        start = np.arange(at[i] - far[i], at[i] - near[i] + 1)
                        hashes = window_hash(prefix, start - lo, start - lo + SPAN) ^ mix64((at[i] - start).astype(_U))
                        hot.append((int(key), int(core[i]), int(spot[i]), as_long(hashes)))
            if hot:
                yield pd.DataFrame(hot, columns=["key", "core", "spot", "windows"]).assign(part=None, run=None)[
                    ["part", "run", "key", "core", "spot", "windows"]].astype({"part": "Int32"})
            if n > 200_000:
                yield runs().assign(key=None, core=None, spot=None, windows=None).astype(
                    {"key": "Int64", "core": "Int64", "spot": "Int64"})
                held, n = {}, 0
        if n:
            yield runs().assign(key=None, core=None, spot=None, windows=None).astype(
                {"key": "Int64", "core": "Int64", "spot": "Int64"})
    return build


def _apart(*columns: str) -> list:
    """Key columns in another guise, so that a join of an aggregate with its
    own input exchanges both sides and skewed partitions can be split."""
    return [F.bitwise_not(c).alias(f"__{c}") for c in columns]


def _joined(rows: DataFrame, grouped: DataFrame, *keys: str) -> DataFrame:
    left = rows.select("*", *_apart(*keys))
    right = grouped.select(*_apart(*keys), *[c for c in grouped.columns if c not in keys])
    names = [f"__{k}" for k in keys]
    return left.join(right, names).drop(*names)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """key, start, end: spans of bytes covered by repeated windows, for
    ``docs`` (key, text), where equal texts share a key and count once."""
    anchors = docs.mapInPandas(_draw, "core long, extent long, key long, spot long")
    counts = anchors.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    live = materialise(_joined(anchors, counts, "core").distinct(), "anchors")
    calm = live.where(F.col("n") <= HOT).select("key", "core", "spot", F.lit(False).alias("hot"))
    hot = live.where(F.col("n") > HOT).drop("n")

    # hot cores: anchors with equal extents repeat whole; one of each goes on
    extents = materialise(hot.groupBy("core", "extent").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "spot")).alias("one")), "extents")
    whole = _joined(hot, extents.where("n > 1").select("core", "extent"), "core", "extent").select("key", "spot")
    ones = extents.select("one.key", "core", "one.spot", F.lit(True).alias("hot"))

    parts = max(1, -(-calm.count() // RUN_TARGET))
    wanted = calm.union(ones).groupBy("key").agg(F.collect_list(F.struct("core", "spot", "hot")).alias("wanted"))
    texts = _pack_text(docs).join(wanted, "key").select("key", "z", "wanted")
    found = materialise(texts.mapInPandas(
        _contexts(parts), "part int, run binary, key long, core long, spot long, windows array<long>"), "runs")

    runs = found.where("run IS NOT NULL").select("part", "run")
    sorted_spans = runs.repartition(parts, "part").sortWithinPartitions("part").mapInPandas(
        _merge, "key long, start long, end long")
    windows = found.where("windows IS NOT NULL").select(
        "key", "core", "spot", F.posexplode("windows").alias("i", "w"))
    again = windows.groupBy("core", "w").agg(F.count("*").alias("n")).where("n > 1").select("core", "w")
    far = F.shiftright("spot", 8).bitwiseAND(255)
    at = F.shiftright("spot", 16)
    window_spans = _joined(windows, again, "core", "w").groupBy("key", "spot").agg(
        F.min("i").alias("lo"), F.max("i").alias("hi")).select(
        "key", (at - far + F.col("lo")).alias("start"), (at - far + F.col("hi") + SPAN).alias("end"))
    whole_spans = whole.select("key", (at - far).alias("start"),
                               (at - F.col("spot").bitwiseAND(255) + SPAN).alias("end"))
    return sorted_spans.union(window_spans).union(whole_spans)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the bytes
    left) of every row.

    Null texts are empty. Texts under SPAN bytes lose nothing. A text that
    another row repeats is removed whole, if it has SPAN bytes. Null or
    repeated doc_ids do no harm: rows are told apart by their texts.
    """
    keyed = only(docs, "doc_id", "text").withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    spans = repeated_spans(keyed.select("key", "text"))
    copies = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(
        "key", F.lit(0).cast("long").alias("start"), F.lit((1 << 62)).alias("end"))
    cuts = spans.union(copies).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("cuts"))
    joined = _pack_text(keyed, "doc_id").join(cuts, "key", "left").select("doc_id", "z", "cuts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        d = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for z, cuts in zip(batch["z"], batch["cuts"]):
                text = d.decompress(z)
                kept, at, spans = [], 0, 0
                if cuts is not None and len(text) >= SPAN:
                    reach = -1
                    for start, end in sorted((c["start"], min(c["end"], len(text))) for c in cuts):
                        if start > reach:
                            spans += 1
                            kept.append(text[at:start])
                        at = reach = max(reach, end)
                kept = b"".join([*kept, text[at:]])
                rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    return map_frames(
        joined, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur again."""
    return without_repeats(load(spark, sf_dir, "documents")).drop("kept")
