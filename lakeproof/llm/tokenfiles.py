"""Token files: operator 7 (documents compressed one by one under a shared
dictionary, with an offset index) and operator 8 (separator scan of flat files)."""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeproof.llm.common import encoder, load, materialise, only, open_fs, scratch, text_parts, tokenizer_path

MAGIC = b"TOKZ0001"
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 1000, 4096, 65_536
READ_BYTES = 4 << 20


# --- operator 7 ----------------------------------------------------------------

def _width(path: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, path: str, end_id: int, dtype: str) -> bytes:
    """A zstandard dictionary trained on serialized id arrays of a bounded
    sample: about SAMPLE_DOCS documents, picked by their hash where they are,
    SAMPLE_CHARS characters of each from a place that the hash gives too, equal
    ones once. It only steers the compression ratio. Empty where the sample is
    too small to train on."""
    import zstandard
    n = max(1, docs.count())
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))) + 1
    rows = (docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) < SAMPLE_DOCS)
            .select(F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
            .where("text IS NOT NULL").distinct().collect())
    ids, bounds = encoder(path).encode_many(pa.array([r["text"] for r in rows], pa.string()), end_id)
    samples = [ids[lo:hi].astype(dtype).tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
    if sum(map(len, samples)) < 4 * DICT_BYTES // 16 or len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write (doc_id, text) in ascending doc_id order; returns the manifest,
    one row per file in order: file_no, file, n_docs, n_tokens.

    File: magic, JSON header (id type, dictionary hash, counts) with its
    length, one zstandard frame per document, then the index: the documents'
    ids (null ones first, with their number) and their frames' offsets, so that
    one short document is read by two seeks. The dictionary stands once, beside the files, named by its hash.
    A file gets a fresh name on every attempt and counts only once the written
    manifest names it, so lost or repeated tasks leave no wrong result.
    """
    path = tokenizer_path(tokenizer)
    dtype = _width(path)
    docs = only(docs, "doc_id", "text")
    dictionary = train_dictionary(docs, path, end_id, dtype)
    digest = hashlib.sha256(dictionary).hexdigest()
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dict-{digest}") as f:
        f.write(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        enc = encoder(path)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        comp = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
        out, name, doc_ids, offsets, tokens, nulls = None, "", [], [0], 0, 0
        fs, root = open_fs(folder)
        for part in (p for batch in batches for p in text_parts(batch)):
            if out is None:
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.tokz"
                out = fs.open_output_stream(f"{root}/{name}")
                header = json.dumps({"dtype": dtype, "dict": digest, "end_id": end_id}).encode()
                out.write(MAGIC + struct.pack("<I", len(header)) + header)
            ids, bounds = enc.encode_many(part.column("text"), end_id)
            data = ids.astype(dtype)
            frames = [comp.compress(data[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
            out.write(b"".join(frames))
            offsets.extend((offsets[-1] + np.cumsum([len(f) for f in frames])).tolist())
            nulls += part.column("doc_id").null_count
            doc_ids.append(part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            tokens += len(ids)
        if out is not None:
            index = np.concatenate(doc_ids).tobytes() + np.array(offsets, "<u8").tobytes()
            out.write(index + struct.pack("<QQQ", len(offsets) - 1, nulls, tokens) + MAGIC)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]),
                 pa.array([len(offsets) - 1], pa.int64()), pa.array([tokens], pa.int64())],
                ["file_no", "file", "n_docs", "n_tokens"])

    # rows that share a doc_id, or have none, are dealt out by their texts and places
    tied = docs.withColumns({"__text": F.xxhash64("text"), "__tie": F.monotonically_increasing_id()})
    order = ["doc_id", "__text", "__tie"]
    ordered = tied.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return materialise(ordered.mapInArrow(write, "file_no int, file string, n_docs long, n_tokens long"), "manifest")


class TokenFile:
    """Random access to one file: ``ids(i)`` decompresses document i alone."""

    def __init__(self, folder: str, name: str):
        import zstandard
        fs, root = open_fs(folder)
        self.f = fs.open_input_file(f"{root}/{name}")
        size = self.f.size()
        self.f.seek(0)
        head = self.f.read(12)
        self.header = json.loads(self.f.read(struct.unpack("<I", head[8:])[0]))
        self.base = 12 + struct.unpack("<I", head[8:])[0]
        self.f.seek(size - 32)
        tail = self.f.read(32)
        if head[:8] != MAGIC or tail[24:] != MAGIC:
            raise ValueError(f"{name} is no complete token file")
        self.n, self.n_null, self.n_tokens = struct.unpack("<QQQ", tail[:24])
        self.f.seek(size - 32 - 8 * (2 * self.n + 1))
        index = self.f.read(8 * (2 * self.n + 1))
        self.doc_ids = np.frombuffer(index, "<i8", self.n)
        self.offsets = np.frombuffer(index, "<u8", self.n + 1, 8 * self.n).astype(np.int64)
        with fs.open_input_stream(f"{root}/dict-{self.header['dict']}") as d:
            dictionary = d.read()
        if hashlib.sha256(dictionary).hexdigest() != self.header["dict"]:
            raise ValueError("the dictionary is not the one the file was written with")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.d = zstandard.ZstdDecompressor(dict_data=shared)

    def run(self, lo: int, hi: int) -> Iterator[np.ndarray]:
        """The ids of documents lo to hi - 1, from one read."""
        self.f.seek(self.base + int(self.offsets[lo]))
        data = memoryview(self.f.read(int(self.offsets[hi] - self.offsets[lo])))
        at = (self.offsets[lo:hi + 1] - self.offsets[lo]).tolist()
        for a, b in zip(at[:-1], at[1:]):
            yield np.frombuffer(self.d.decompress(data[a:b]), self.header["dtype"]).astype("<u4")

    def ids(self, i: int) -> np.ndarray:
        return next(self.run(i, i + 1))

    def close(self) -> None:
        self.f.close()


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file_no", "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    # one row per file; dealt out again so that files are read in parallel
    files = files.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4), "file_no")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            tf = TokenFile(folder, row["file"])
            place, lo = row["base"], 0
            while lo < tf.n:
                within = int(np.searchsorted(tf.offsets, tf.offsets[lo] + READ_BYTES, "right")) - 1
                hi = min(tf.n, lo + 10_000, max(lo + 1, within))
                found = [(len(ids), zlib.crc32(ids)) for ids in tf.run(lo, hi)]
                sizes = np.array([n for n, _ in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tf.doc_ids[lo:hi], pa.int64(), mask=np.arange(lo, hi) < tf.n_null),
                     pa.array(place + np.cumsum(sizes) - sizes), pa.array(sizes),
                     pa.array([crc for _, crc in found], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                place, lo = place + int(sizes.sum()), hi
            tf.close()

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written and read back. Null text: the end id alone.
    Null doc_ids sort first; repeated ones keep one record each, in any order
    among themselves. Long texts are a batch of their own, held whole in one
    task. An empty table gives no files and no rows."""
    folder = scratch(spark, "tokz")
    return read_token_files(write_token_files(load(spark, sf_dir, "documents"), folder), folder)


# --- operator 8 ----------------------------------------------------------------

BLOCK_TOKENS = 1 << 20


def write_flat_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 49_407) -> DataFrame:
    """Flat files of ids (end id after each document, nothing else), one per
    input partition. Special tokens in a text are encoded as ordinary text, so
    the end id marks ends only. Returns who stands where, for naming the
    documents afterwards: file, ordinal, doc_id, and on a file's last row its
    length in ids."""
    path = tokenizer_path(tokenizer)
    dtype = _width(path)
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, True)
        name = f"flat-{uuid.uuid4().hex}.bin"
        out, n, tokens, held = None, 0, 0, None
        def rows(last: int | None = None) -> pa.RecordBatch:
            m = held.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * m), pa.array(np.arange(n - m, n)), held.column("doc_id"),
                 pa.array([None] * (m - 1) + [last], pa.int64())], ["file", "ordinal", "doc_id", "file_tokens"])

        for part in (p for batch in batches for p in text_parts(batch)):
            if out is None:
                fs, root = open_fs(folder)
                out = fs.open_output_stream(f"{root}/{name}")
            else:
                yield rows()
            ids, _ = enc.encode_many(part.column("text"), end_id)
            out.write(ids.astype(dtype).tobytes())
            tokens += len(ids)
            held = part
            n += part.num_rows
        if out is not None:
            out.close()
            yield rows(tokens)

    return materialise(only(docs, "doc_id", "text").mapInArrow(
        write, "file string, ordinal long, doc_id long, file_tokens long"), "flat")


def scan_separators(files: DataFrame, folder: str, end_id: int = 49_407, dtype: str = "<u2",
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, ordinal, start, n_tokens (end id included), terminated, of every
    document in the flat ``files`` (file, file_tokens).

    Blocks of equal length are searched apart, with one vector comparison each;
    a block tells its separators' places. A prefix scan over the blocks of a
    file then gives each block the number of documents and the last separator
    before it, which closes the document that spans the block's left edge,
    however many blocks it spans. Ids after a file's last separator are a
    document with ``terminated`` false; an empty file has none.
    """
    size = np.dtype(dtype).itemsize
    blocks = (files.where("file_tokens > 0")
              .select("file", "file_tokens",
                      F.explode(F.sequence(F.lit(0).cast("long"),
                                           ((F.col("file_tokens") - 1) / block_tokens).cast("long"))).alias("block")))
    blocks = blocks.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4), "file", "block")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        for batch in batches:
            for file, total, block in zip(batch["file"], batch["file_tokens"], batch["block"]):
                lo = int(block) * block_tokens
                n = min(block_tokens, int(total) - lo)
                with fs.open_input_file(f"{root}/{file}") as f:
                    f.seek(lo * size)
                    ids = np.frombuffer(f.read(n * size), dtype)
                ends = np.flatnonzero(ids == end_id) + lo + 1
                closed = len(ends)
                if lo + n == total and (not closed or ends[-1] != total):
                    ends = np.append(ends, total)
                yield pd.DataFrame({"file": [file], "block": [block], "ends": [ends], "n_ends": [len(ends)],
                                    "last_end": pd.array([int(ends[-1]) if len(ends) else None], "Int64"),
                                    "closed": [closed]})

    found = blocks.mapInPandas(
        scan, "file string, block long, ends array<long>, n_ends long, last_end long, closed long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "file", "ends", "closed",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max("last_end").over(before), F.lit(0)).alias("end_before"))
    return (stitched
            .select("*", F.expr("transform(ends, (e, i) -> struct(docs_before + i AS ordinal, "
                                "if(i = 0, end_before, ends[i - 1]) AS start, e AS end, i < closed AS terminated))")
                    .alias("docs"))
            .select("file", F.explode("docs").alias("d"))
            .select("file", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"),
                    "d.terminated"))


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by scanning flat token files. A null
    text is an end id alone, a null doc_id stays null, repeated rows are counted
    each; an empty table gives no rows."""
    folder = scratch(spark, "flat-files")
    where = write_flat_files(load(spark, sf_dir, "documents"), folder)
    files = where.where("file_tokens is not null").select("file", "file_tokens")
    counted = scan_separators(files, folder)
    return (where.select("file", "ordinal", "doc_id").join(counted.hint("merge"), ["file", "ordinal"])
            .select("doc_id", "file", "ordinal", "start", "n_tokens", "terminated"))
