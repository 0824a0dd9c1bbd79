"""Token ids of documents in binary files: Simple-8b blocks with an index, written and read by tasks.

A file holds, little-endian: the magic, the words of all blocks, the offset of each block's first word,
and of each document its id, whether the id is null, and its number of ids; then three counts and the
magic again. Files are named in ascending order of documents. They go through pyarrow's file systems, so
a folder can be in any store that those reach; a file appears under its name only when it is whole, and
a task that runs again writes the same bytes.
"""
from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import new_folder, staged
from .tokens import encoder

MAGIC = b"S8BIDS01"
#: Ids a file holds before the next one begins; a longer document is whole in one file.
FILE_IDS = 4_000_000


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_file(folder: str, name: str, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
    words, offsets = simple8b.encode(ids)
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    hidden = f"{root}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as f:
        f.write(MAGIC)
        f.write(words.astype("<u8").tobytes())
        f.write(offsets.astype("<i8").tobytes())
        f.write(np.array([i or 0 for i in doc_ids], "<i8").tobytes())
        f.write(np.array([i is None for i in doc_ids], np.uint8).tobytes())
        f.write(lengths.astype("<i8").tobytes())
        f.write(struct.pack("<QQQ", len(words), len(offsets), len(doc_ids)) + MAGIC)
    files.move(hidden, f"{root}/{name}")


def read_file(folder: str, name: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, the number of ids of each, and all ids end to end."""
    files, root = _open(folder)
    with files.open_input_stream(f"{root}/{name}") as f:
        data = f.read()
    tail = len(data) - 24 - len(MAGIC)
    n_words, n_offsets, n_docs = struct.unpack_from("<QQQ", data, tail)
    if data[: len(MAGIC)] != MAGIC or data[-len(MAGIC):] != MAGIC or tail != len(MAGIC) + 8 * (n_words + n_offsets) + 17 * n_docs:
        raise ValueError(f"{folder}/{name} is not a whole file of token ids")
    at = len(MAGIC)
    words = np.frombuffer(data, "<u8", n_words, at)
    at += 8 * (n_words + n_offsets)
    doc_ids = np.frombuffer(data, "<i8", n_docs, at)
    null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(data, "<i8", n_docs, at + 9 * n_docs)
    return [None if z else i for i, z in zip(doc_ids.tolist(), null.tolist())], lengths, simple8b.decode(words)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of every document, in ascending order of ids (null first; rows that repeat an id in
    order of their texts' hash), into folder. Returns a written manifest: file, part, number, n_docs, n_ids.
    A null text is an empty one: its document has the end id alone. An empty table gives no file."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = rows.select("doc_id", F.encode("text", "UTF-8").alias("text"), F.spark_partition_id().alias("part"))

    def run(batches):
        words = encoder(tokenizer)
        doc_ids, lengths, ids, held, number = [], [], [], 0, 0
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            part = batch.column("part")[0].as_py() if len(texts) else 0
            for i in range(0, len(texts), 256):
                flat, bounds = words.encode(texts[i:i + 256])
                doc_ids += keys[i:i + 256]
                lengths.append(np.diff(bounds))
                ids.append(flat)
                held += len(flat)
                if held >= file_ids:
                    yield flush(part, number, doc_ids, lengths, ids)
                    doc_ids, lengths, ids, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flush(part, number, doc_ids, lengths, ids)

    def flush(part, number, doc_ids, lengths, ids):
        name, lengths, ids = f"ids-{part:06d}-{number:06d}.s8b", np.concatenate(lengths), np.concatenate(ids)
        write_file(folder, name, doc_ids, lengths, ids)
        return pa.RecordBatch.from_pylist([{"file": name, "part": part, "number": number, "n_docs": len(doc_ids), "n_ids": len(ids)}],
                                          schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return staged(rows.mapInArrow(run, "file string, part int, number int, n_docs long, n_ids long"), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), ids (array)."""
    return _from_files(manifest, folder, "doc_id long, start long, ids array<int>", pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))]),
                       lambda keys, lengths, start, ids: [keys, start, [x.astype(np.int32) for x in np.split(ids, np.cumsum(lengths)[:-1])]])


def read_token_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """As read_token_files, with n_tokens and ids_crc32 (of little-endian unsigned 32-bit ids) for the ids."""
    def digests(keys, lengths, start, ids):
        raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths)
        return [keys, start, lengths, [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]]

    return _from_files(manifest, folder, "doc_id long, start long, n_tokens long, ids_crc32 long",
                       pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]), digests)


def _from_files(manifest: DataFrame, folder: str, ddl: str, schema: pa.Schema, make) -> DataFrame:
    # One row a part, then one row a file: the running sums never see more than those.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("part_ids")).withColumn("before", F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("within", within).join(parts.select("part", "before"), "part").select("file", (F.col("before") + F.col("within")).alias("start"))

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                keys, lengths, ids = read_file(folder, name)
                for i in range(0, len(keys), 2000):  # bounded batches to the JVM
                    some, at = lengths[i:i + 2000], int(lengths[:i].sum())
                    first = start + at + np.cumsum(some) - some
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(make(keys[i:i + 2000], some, first, ids[at:at + int(some.sum())]), schema)], schema=schema)

    # By number, so that the few small rows are not coalesced into one task: each is a whole file to read.
    return files.repartition(max(1, manifest.count()), "file").mapInArrow(run, ddl)


def token_file_digests(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes all documents into a new shared folder and reads them back: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(spark, "token-ids")
    return read_token_digests(write_token_files(docs, folder, tokenizer), folder)
