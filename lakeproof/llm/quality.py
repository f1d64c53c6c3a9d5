"""Operator 2: quality classifier by co-training.

Two views of a document are judged apart: its text (presence of words, word
beginnings and punctuation runs) and its page metadata (language, source,
lengths and the form of the page). Over some rounds each view labels the
documents of an unlabelled pool that it is sure of, and these train the other
view. Both views are then calibrated, and a small model on the calibrated
views, fitted on labelled rows held back so far, scores all documents.

Training takes a bounded sample of labelled rows (LABELLED) and of other rows
(those of 2 * POOL documents that have no label), by the hash of doc_id. Their texts are turned into features
whole, inside the tasks, and only the features are collected; scoring reads all
documents whole. Two targets are learnt: low quality and toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm.common import by_bytes, load, map_frames, mix64, only, prefix_hash, window_hash

LABELLED, POOL = 6000, 3000
ROUNDS, SURE, PER_ROUND = 3, 0.99, 400
BUCKETS, FEATURES = 1 << 20, 512
BEGINNINGS = (3, 4, 5, 6)
TARGETS = ("low_quality", "toxic")
REJECT = 0.5

_U = np.uint64
_KIND = np.zeros(256, np.int8)  # 0 blank, 1 punctuation, 2 word
_KIND[33:127] = 1
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 2


class Parsed:
    """Tokens of a batch of texts: runs of word characters or of punctuation."""

    def __init__(self, texts: list[str | None]):
        raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
        self.raw = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        self.first = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
        data = self.raw
        self.low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        kind = _KIND[data]
        cut = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
        start = cut[kind[cut] > 0]
        stop = np.append(cut, len(data))[1:][kind[cut] > 0]
        self.start, self.stop, self.word = start, stop, kind[start] == 2
        self.hash = prefix_hash(self.low)
        self.whole = window_hash(self.hash, start, stop)
        self.doc = np.searchsorted(self.first, start, "right") - 1

    def buckets(self, picked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(document, bucket) of each feature present, each pair once; with
        ``picked`` (a table of columns, -1: none) (document, column) instead."""
        docs, found = [], []
        words = np.flatnonzero(self.word)
        for n in (*BEGINNINGS, 0):
            if n:
                at = words[self.stop[words] - self.start[words] > n]
                h = window_hash(self.hash, self.start[at], self.start[at] + n) ^ _U(n)
            else:
                at, h = slice(None), self.whole
            bucket = (mix64(h) >> _U(44)).astype(np.int64)
            doc = self.doc[at]
            if picked is not None:
                bucket = picked[bucket]
                doc, bucket = doc[bucket >= 0], bucket[bucket >= 0]
            docs.append(doc)
            found.append(bucket)
        pair = np.unique(np.concatenate(docs) * BUCKETS + np.concatenate(found))
        return pair // BUCKETS, pair % BUCKETS

    def form(self) -> np.ndarray:
        """Length and form of each page, as numbers of about unit size."""
        n = np.diff(self.first).astype(float)
        lo = self.first[:-1]

        def share(mask):
            return np.add.reduceat(mask.astype(np.int64), lo) / n

        tokens = np.maximum(np.bincount(self.doc, minlength=len(n)), 1)
        same = np.zeros(len(self.start), bool)
        same[1:] = (self.whole[1:] == self.whole[:-1]) & (self.doc[1:] == self.doc[:-1])
        after = np.zeros(len(self.start), bool)  # the token before last again: "ab | cd |"
        after[2:] = (self.whole[2:] == self.whole[:-2]) & (self.doc[2:] == self.doc[:-2])
        words = np.maximum(np.bincount(self.doc, self.word, minlength=len(n)), 1)
        raw = self.raw
        return np.column_stack([
            np.log(n), np.log1p(share(raw == 10) * n),
            10 * share((raw >= 65) & (raw <= 90)), 10 * share(_KIND[raw] == 1), 10 * share((raw >= 48) & (raw <= 57)),
            10 * share(raw >= 128), np.bincount(self.doc, same, minlength=len(n)) / tokens,
            np.bincount(self.doc, after, minlength=len(n)) / tokens,
            np.bincount(self.doc, self.word * (self.stop - self.start), minlength=len(n)) / words / 5])


def _meta(frame: pd.DataFrame, parsed: Parsed) -> np.ndarray:
    """Form of the page, and language and source as hashed indicators."""
    size, out = 64, [parsed.form()]
    for name in ("lang", "source"):
        one = np.zeros((len(frame), size))
        if name in frame.columns:
            values = [str(v).encode() + b"\n" for v in frame[name]]
            data = np.frombuffer(b"".join(values), np.uint8)
            stop = np.cumsum([len(v) for v in values])
            start = stop - [len(v) for v in values]
            one[np.arange(len(frame)), (window_hash(prefix_hash(data), start, stop) >> _U(58)).astype(int)] = 1
        out.append(one)
    return np.hstack(out)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights (bias last) by Newton's method with a ridge penalty."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64, copy=False)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _logit(x: np.ndarray, w: np.ndarray, rows: int = 2048) -> np.ndarray:
    """By blocks of rows, as a block of single precision is copied in double."""
    blocks = [x[lo:lo + rows] @ w[:-1] for lo in range(0, len(x), rows)]
    return np.concatenate([np.zeros(0), *blocks]) + w[-1]


class TextView:
    """Presence of the FEATURES buckets that tell the classes apart best."""

    def __init__(self, doc: np.ndarray, bucket: np.ndarray, y: np.ndarray, rows: np.ndarray):
        label = np.full(max(len(y), int(doc.max(initial=0)) + 1), -1, np.int8)
        label[rows] = y[rows]
        hits, seen = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
        for lo in range(0, len(doc), 1 << 18):
            own, found = label[doc[lo:lo + (1 << 18)]], bucket[lo:lo + (1 << 18)]
            np.add.at(seen, found[own >= 0], 1)
            np.add.at(hits, found[own > 0], 1)
        n, pos = len(rows), max(float(y[rows].sum()), 1e-9)
        # chi-squared of presence against class, for buckets seen often enough
        often = np.flatnonzero(seen >= 5)
        hits, seen = hits[often].astype(float), seen[often].astype(float)
        expected = seen * pos / n
        with np.errstate(divide="ignore", invalid="ignore"):
            chi = (hits - expected) ** 2 / (expected * (1 - pos / n) * (1 - seen / n))
        chi[~np.isfinite(chi)] = 0
        best = np.argsort(-chi, kind="stable")[:FEATURES]
        self.picked = np.full(BUCKETS, -1, np.int32)
        best = often[best[chi[best] > 0]]
        self.picked[best] = np.arange(len(best))
        self.width = max(len(best), 1)

    def matrix(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, self.width), np.float32)
        for lo in range(0, len(doc), 1 << 20):
            column = self.picked[bucket[lo:lo + (1 << 20)]]
            out[doc[lo:lo + (1 << 20)][column >= 0], column[column >= 0]] = 1
        return out


def _features(docs: DataFrame, target_columns: list[str]) -> DataFrame:
    """doc_id and the targets as they are, with the buckets (int32) and the
    metadata (float64) of the whole text as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in by_bytes(batches):
            parsed = Parsed(part["text"].tolist())
            doc, bucket = parsed.buckets()
            own = np.split(bucket.astype(np.int32), np.searchsorted(doc, np.arange(1, len(part))))
            yield part[["doc_id", *target_columns]].assign(
                buckets=[b.tobytes() for b in own], meta=[m.tobytes() for m in _meta(part, parsed)])

    return docs.mapInPandas(run, "doc_id long, " + "".join(f"{c} double, " for c in target_columns)
                            + "buckets binary, meta binary")


def _sample(docs: DataFrame, labels: DataFrame, target_columns: list[str]) -> pd.DataFrame:
    """Features of labelled and pool documents; a doc_id labelled more than once has the
    mean of its labels, rounded."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.round(F.avg(c)).cast("double").alias(c) for c in target_columns])

    def some(rows: DataFrame, n: int) -> DataFrame:
        """About n rows, by the hash of doc_id: bounded, and picked in place."""
        return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(max(1, rows.count()))) < n)

    taken = some(marks, LABELLED)
    others = (some(docs.select("doc_id").where("doc_id IS NOT NULL").distinct(), 2 * POOL)
              .join(marks.select("doc_id"), "doc_id", "left_anti")
              .select("doc_id", *[F.lit(None).cast("double").alias(c) for c in target_columns]))
    chosen = taken.union(others)  # about LABELLED + 2 * POOL rows at most
    return (_features(docs.join(F.broadcast(chosen), "doc_id"), target_columns).toPandas()
            .drop_duplicates("doc_id").sort_values("doc_id").reset_index(drop=True))


def co_train(text: tuple[np.ndarray, np.ndarray], meta: np.ndarray, y: np.ndarray, seed: int = 5) -> dict | None:
    """One target's model; y is NaN where unlabelled. None: only one class."""
    n = len(y)
    known = np.flatnonzero(~np.isnan(y))
    order = known[np.argsort(mix64(known.astype(_U) + _U(seed)))]
    held, train = order[:len(order) // 4], order[len(order) // 4:]
    if len(train) < 20 or len(set(y[train])) < 2 or len(set(y[held])) < 2:
        return None
    pool = np.flatnonzero(np.isnan(y))
    mean, spread = meta.mean(axis=0), meta.std(axis=0) + 1e-3
    scaled = (meta - mean) / spread
    guess = {"text": y.copy(), "meta": y.copy()}
    rows = {"text": train, "meta": train}
    for turn in range(ROUNDS + 1):
        view = TextView(*text, np.nan_to_num(guess["text"]), rows["text"])
        x = view.matrix(*text, n)
        w_text = fit_logistic(x[rows["text"]], guess["text"][rows["text"]])
        w_meta = fit_logistic(scaled[rows["meta"]], guess["meta"][rows["meta"]])
        p_text, p_meta = _sigmoid(_logit(x, w_text)), _sigmoid(_logit(scaled, w_meta))
        if turn == ROUNDS:
            break
        for name, other, p in (("meta", "text", p_text), ("text", "meta", p_meta)):
            free = np.setdiff1d(pool, rows[name])
            sure = free[np.maximum(p[free], 1 - p[free]) >= SURE]
            sure = sure[np.argsort(-np.abs(p[sure] - 0.5), kind="stable")]
            # as many of each class as the classes' shares among the labels
            share = y[train].mean()
            take = np.concatenate([sure[p[sure] > 0.5][:int(np.ceil(PER_ROUND * share))],
                                   sure[p[sure] < 0.5][:int(np.ceil(PER_ROUND * (1 - share)))]])
            guess[name][take] = (p[take] > 0.5).astype(float)
            rows[name] = np.concatenate([rows[name], take])
    # calibrate each view on the held-out rows, then combine the calibrated views
    z = [_logit(x, w_text), _logit(scaled, w_meta)]
    calibration = [fit_logistic(v[held, None], y[held], 0.1) for v in z]
    views = np.column_stack([np.clip(_logit(v[:, None], c), -12, 12) for v, c in zip(z, calibration)])
    return {"picked": view.picked, "width": view.width, "w_text": w_text, "w_meta": w_meta, "mean": mean,
            "spread": spread, "calibration": calibration, "combine": fit_logistic(views[held], y[held], 0.1)}


def train(docs: DataFrame, labels: DataFrame) -> dict[str, dict | None]:
    """Models of both targets. ``labels``: doc_id, quality (1 good), toxic."""
    marks = only(labels, "doc_id", "quality", "toxic").select(
        "doc_id", (F.lit(1) - F.col("quality")).alias("low_quality"), "toxic")
    names = [c for c in ("doc_id", "text", "lang", "source") if c in docs.columns]
    frame = _sample(only(docs, *names), marks, list(TARGETS))
    if not len(frame):
        return dict.fromkeys(TARGETS)
    sizes = frame["buckets"].str.len().to_numpy() // 4
    features = (np.repeat(np.arange(len(frame), dtype=np.int32), sizes),
                np.frombuffer(b"".join(frame.pop("buckets")), np.int32))
    meta = np.frombuffer(b"".join(frame.pop("meta")), np.float64).reshape(len(frame), -1)
    pa.default_memory_pool().release_unused()  # what the collected features held
    return {t: co_train(features, meta, frame[t].to_numpy(float)) for t in TARGETS}


def _scored(batch: pd.DataFrame, models: dict[str, dict | None]) -> pd.DataFrame:
    """Scores of a batch that isn't empty, and kept."""
    parsed = Parsed(batch["text"].tolist())
    meta = _meta(batch, parsed)
    rejected = np.zeros(len(batch), bool)
    out = {}
    for t in TARGETS:
        m = models[t]
        if m is None:
            out |= {f"{v}_{t}": np.full(len(batch), np.nan) for v in ("p", "text", "meta")}
            continue
        doc, column = parsed.buckets(m["picked"])
        z_text = np.bincount(doc, m["w_text"][column], len(batch)) + m["w_text"][-1]
        z_meta = _logit((meta - m["mean"]) / m["spread"], m["w_meta"])
        views = np.column_stack([np.clip(_logit(v[:, None], c), -12, 12)
                                 for v, c in zip((z_text, z_meta), m["calibration"])])
        p = _sigmoid(_logit(views, m["combine"]))
        rejected |= p >= REJECT
        out |= {f"p_{t}": p, f"text_{t}": _sigmoid(views[:, 0]), f"meta_{t}": _sigmoid(views[:, 1])}
    return pd.DataFrame(out | {"kept": ~rejected})


def score(docs: DataFrame, models: dict[str, dict | None]) -> DataFrame:
    """doc_id and, for each target, p_<target>, text_<target>, meta_<target>;
    kept unless a target reaches REJECT. Without a model (no labels, or one
    class only) a target's scores are null and reject nothing. Null and empty
    texts are scored by their metadata and the text view's bias."""
    names = [c for c in ("doc_id", "text", "lang", "source") if c in docs.columns]
    fields = [f"{v}_{t} double" for t in TARGETS for v in ("p", "text", "meta")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_bytes(batches):
            out = _scored(batch, models)
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    return map_frames(only(docs, *names), run, "doc_id long, " + ", ".join(fields) + ", kept boolean")


def accepted(docs: DataFrame, models: dict[str, dict | None]) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = [c for c in ("text", "lang", "source") if c in batch.schema.names]
                parts = by_bytes(iter([batch.select(names).to_pandas()]))
                kept = pd.concat([_scored(part, models)["kept"] for part in parts])
                yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def op2_co_training_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents from models trained on ``labels``."""
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(docs, load(spark, sf_dir, "labels")))
