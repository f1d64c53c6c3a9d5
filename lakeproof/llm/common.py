"""Helpers shared by the training-data operators: shared scratch tables, token
ids, and vectorised hashing of byte and word windows inside tasks."""

from __future__ import annotations

import functools
import re
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeproof.session import ensure_checkpoint_dir, read_bytes

TOKENIZER_FILE = "word_bpe_49k.json"
PART_BYTES = 128 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of texts and what a task makes of it must
    fit beside the JVM in an executor, whatever the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder (URI) under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("/"):
        base = "file://" + base
    elif base.startswith("file:/") and not base.startswith("file:///"):
        base = "file://" + base[len("file:"):]
    return f"{base}/llm/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back: cuts the lineage,
    survives lost executors, and gives later passes a pruned columnar scan."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(df: DataFrame, per_core: int = 1) -> DataFrame:
    """``df`` in no more parts than ``per_core`` a core or the bytes of the tables
    it reads ask for: each part that is written is a file, and a small table
    would else have one for each shuffle partition or split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(min(max(cores * per_core, read_bytes(df) // PART_BYTES), 2 ** 31 - 1))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra columns of any name can't clash."""
    return df.select(*columns)


# --- tasks -------------------------------------------------------------------

Frames = Iterator[pd.DataFrame]


def _frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """pandas turns whole numbers beside a null into doubles, which cannot
    hold every long; such columns are made nullable integers instead."""
    exact = [f.name for f in batch.schema if pa.types.is_integer(f.type) and batch.column(f.name).null_count]
    frame = batch.drop_columns(exact).to_pandas() if exact else batch.to_pandas()
    for name in exact:
        column = batch.column(name)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        frame[name] = pd.arrays.IntegerArray(values.astype(np.int64), column.is_null().to_numpy(zero_copy_only=False))
    return frame[batch.schema.names]


def map_frames(rows: DataFrame, fn: Callable[[Frames], Frames], schema: str) -> DataFrame:
    """``mapInPandas`` whose whole numbers stay exact beside nulls."""
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in fn(map(_frame, batches)):
            yield pa.RecordBatch.from_pandas(frame, schema=wanted, preserve_index=False)

    return rows.mapInArrow(run, schema)


def text_parts(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut so that its texts hold about ``limit`` bytes; a longer text
    is a part of its own. An empty batch has no parts."""
    if batch.num_rows:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = size.astype(np.int64).cumsum()
        cuts = np.flatnonzero(np.diff(ends // limit)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(lo, hi - lo)


# --- token ids ---------------------------------------------------------------

def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


_TAIL = ".,!?;:"
_PLAIN = re.compile(f"([A-Za-zÀ-ÖØ-öø-ÿ]+)([{_TAIL}]*)")


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class TokenEncoder:
    """Ids of whole texts as little-endian uint32 bytes, equal to the
    library's ``encode(text, add_special_tokens=False)``.

    The tokenizer's pre-tokenizer always breaks at white space and drops it,
    so the ids of a text are those of its blank-separated chunks in order;
    chunks repeat and are kept in a bounded cache. A chunk that is one word of
    Latin letters with an optional punctuation tail goes to the model directly
    (its normal form is its lower case), any other through the whole pipeline.
    """

    MAX_CHUNKS, MAX_WORDS = 600_000, 400_000

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model
        self.alphabet = _byte_chars()
        self.words: dict[str, bytes] = {}
        encoder = self

        class Chunks(dict):
            def __missing__(self, chunk: str) -> bytes:
                if len(self) >= encoder.MAX_CHUNKS:
                    self.clear()
                word = chunk.rstrip(_TAIL)
                if word.isascii() and word.isalpha():  # most of all chunks
                    ids = encoder._word(word.lower())
                    if len(word) < len(chunk):
                        ids += encoder._word(chunk[len(word):])
                else:
                    ids = encoder._chunk(chunk)
                self[chunk] = ids
                return ids

        self.chunks = Chunks()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.MAX_WORDS:
                self.words.clear()
            if word[0].isalpha():
                chars = word if word.isascii() else "".join(self.alphabet[b] for b in word.encode())
                found = [t.id for t in self.model.tokenize(chars)]
                ids = struct.pack(f"<{len(found)}I", *found)
            else:
                ids = self._whole(word)
            self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return self._whole(chunk) if chunk else b""
        word, tail = plain.groups()
        return self._word(word.lower()) + (self._word(tail) if tail else b"")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        text = text.replace("\n", " ").replace("\t", " ")
        return b"".join(map(self.chunks.__getitem__, text.split(" ")))

    def encode_many(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts (null: empty), each with ``end_id`` behind it:
        one flat uint32 array, and the texts' bounds in it."""
        end = struct.pack("<I", end_id)
        own = [self.encode(t) + end for t in texts.to_pylist()]
        bounds = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(ids) // 4 for ids in own], out=bounds[1:])
        return np.frombuffer(b"".join(own), "<u4"), bounds


@functools.lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = False) -> TokenEncoder:
    """One encoder per Python worker, kept across its tasks."""
    return TokenEncoder(path, special_as_text)


# --- files on shared storage -------------------------------------------------

def open_fs(uri: str):
    """(file system, path) of a URI on any store that Arrow reads."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def by_bytes(batches: Iterator[pd.DataFrame], limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Batches cut so that their texts hold about ``limit`` characters; a
    longer text is a batch of its own. Empty batches are left out."""
    for batch in batches:
        if len(batch):
            size = batch["text"].str.len().fillna(0).to_numpy(float).cumsum()
            cuts = np.flatnonzero(np.diff(size // limit)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                yield batch.iloc[lo:hi].reset_index(drop=True)


# --- hashing -----------------------------------------------------------------

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, odd multipliers)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _table(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x2545F4914F6CDD1D) + _U(seed))


_BYTE = _table(256, 17)
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, _U), np.full(n, _INVERSE, _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(n).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] the polynomial hash (mod 2**64) of the first i bytes; the
    hash of data[i:j] is mix64((P[j] - P[i]) * inverse powers[i])."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal strings hash alike wherever they stand."""
    return mix64((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(_U))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(_U, copy=False).view(np.int64)
