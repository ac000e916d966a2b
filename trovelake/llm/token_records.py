"""Token ids as length-delimited binary records, with a separate offset index.

A folder holds ``records/chunk=<name>/`` with one file each, and ``index/``, a
Parquet table. A file is a run of frames and a closing line end. A frame is

    length of the payload   8 bytes, little-endian
    masked CRC of these     4 bytes
    payload
    masked CRC of it        4 bytes

and the payload of a document is a flag byte (1: doc_id is null, 2: ids take two
bytes, else four), doc_id (8 bytes), the number of ids (4) and the ids. A masked
CRC is the CRC-32 rotated right by 15 bits plus 0xA282EAD8, so that a CRC stored
inside checked data does no harm. Names of chunks ascend with doc_id, and frames
within a file do. The index (doc_id, chunk, offset, length, n_tokens) is made
from the written files and finds any record without reading the others of its
file in order, for shuffled reads.

Documents are dealt by ranges of doc_id and sorted within; a chunk is closed at
``CHUNK_BYTES``, so a task holds one chunk, and no folder has a driver-made
list. Files are written and read by Spark, on any file system it knows.

* A null text is an empty one: its record holds the end id alone.
* Rows that repeat a doc_id are each a record, in the order of their texts; a
  null doc_id stands first.
* Texts of any length are encoded whole; one record may exceed ``CHUNK_BYTES``
  and then has a file of its own size. An empty table gives no records.
* Extra columns are not read. A broken frame or checksum raises an error.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trovelake.llm.bpe_trie import Encoder, packed_ids, slices, vocabulary_path
from trovelake.llm.common import query, rows_out, table, worker_cache
from trovelake.session import shared_folder

CHUNK_BYTES = 8 << 20
END_ID = 2
NULL_ID, NARROW = 1, 2
HEAD = "<BqI"   # flags, doc_id, number of ids


class LibraryEncoder(Encoder):
    """Texts -> packed ids by the tokenizers library, which is asked for each
    distinct word that the worker does not remember (see ``Encoder``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.start({token.content: number for number, token in added.items()})

    def encoded_words(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [packed_ids(e.ids) for e in found]


def library_encoder(path: str) -> LibraryEncoder:
    cache = worker_cache("library_encoders")
    if path not in cache:
        cache[path] = LibraryEncoder(path)
    return cache[path]


def masked(content: bytes) -> int:
    crc = zlib.crc32(content)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload,
                     struct.pack("<I", masked(payload))))


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of every frame of a file; checks lengths and checksums."""
    at, end = 0, len(content) - 1
    if end < 0 or content[end:] != b"\n":
        raise ValueError("the file does not end in a line end")
    while at < end:
        payload = content[at + 12:at + 12 + struct.unpack_from("<Q", content, at)[0]]
        if frame(payload) != content[at:at + len(payload) + 16]:
            raise ValueError(f"broken frame at byte {at}")
        yield at, payload
        at += len(payload) + 16
    if at != end:
        raise ValueError("the last frame is cut off")


def payload_of(doc_id: int | None, packed: bytes) -> bytes:
    """Serialize a document's ids (packed as 32-bit integers)."""
    ids = np.frombuffer(packed, dtype="<u4")
    narrow = not len(ids) or int(ids.max()) < 1 << 16
    flags = (doc_id is None) * NULL_ID | narrow * NARROW
    body = ids.astype("<u2").tobytes() if narrow else packed
    return struct.pack(HEAD, flags, doc_id or 0, len(ids)) + body


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids (32-bit) of a payload."""
    flags, doc_id, count = struct.unpack_from(HEAD, payload)
    kind = "<u2" if flags & NARROW else "<u4"
    ids = np.frombuffer(payload, dtype=kind, count=count, offset=struct.calcsize(HEAD)).astype("<u4")
    return None if flags & NULL_ID else doc_id, ids


BLOCKS = pa.schema([("value", pa.binary()), ("chunk", pa.string())])


def written(documents: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Encode the texts and write the records and their index to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = library_encoder(path), struct.pack("<I", end_id)
        task, number = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            return rows_out(BLOCKS, {"value": [b"".join(held)],
                                     "chunk": [f"c{task:08d}-{number:06d}"]})

        for batch in batches:
            for keys, texts in slices(batch):
                for key, packed in zip(keys, own.encoded(texts)):
                    held.append(frame(payload_of(key, packed + end)))
                    size += len(held[-1])
                    if size >= CHUNK_BYTES:
                        yield chunk()
                        held, size, number = [], 0, number + 1
        if held:
            yield chunk()

    dealt = documents.select("doc_id", "text").repartitionByRange("doc_id")
    blocks = dealt.sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "value binary, chunk string")
    # the bytes pass unchanged: a cast to string does not look at them
    blocks.select(F.col("value").cast("string").alias("value"), "chunk").write.partitionBy(
        "chunk").text(f"{folder}/records")
    records(documents.sparkSession, folder).select(
        "doc_id", "chunk", "offset", "length", "n_tokens").write.parquet(f"{folder}/index")


ROWS = pa.schema([("doc_id", pa.int64()), ("chunk", pa.string()), ("offset", pa.int64()),
                  ("length", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])


def files(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        f"{folder}/records")
    chunk = F.regexp_extract("path", "/chunk=([^/]+)/[^/]+$", 1)
    return found.select(chunk.alias("chunk"), "content").where("chunk <> ''")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files: doc_id, chunk, offset, length, ids of the
    chunk before it, n_tokens and the CRC-32 of its ids as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["chunk"].to_pylist(), batch["content"].to_pylist()):
                out: dict[str, list] = {n: [] for n in ROWS.names}
                before = 0
                for offset, payload in frames(content):
                    doc_id, ids = ids_of(payload)
                    for column, value in zip(ROWS.names, (
                            doc_id, name, offset, len(payload) + 16, before, len(ids),
                            zlib.crc32(ids.tobytes()))):
                        out[column].append(value)
                    before += len(ids)
                yield rows_out(ROWS, out)

    return files(spark, folder).mapInArrow(
        run, "doc_id long, chunk string, offset long, length long, before long, "
             "n_tokens long, ids_crc32 long")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files."""
    rows = records(spark, folder)
    # a row per file of CHUNK_BYTES, from the index
    sizes = spark.read.parquet(f"{folder}/index").groupBy("chunk").agg(
        F.sum("n_tokens").alias("size"))
    earlier = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("chunk", F.coalesce(F.sum("size").over(earlier), F.lit(0))
                          .alias("chunk_start"))
    return rows.join(starts, "chunk").select(
        "doc_id", (F.col("chunk_start") + F.col("before")).cast("long").alias("start"),
        "n_tokens", "ids_crc32")


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """(doc_id, ids) of all records in an order drawn by ``seed``: the index is
    put in that order, and each record is cut out of its file by its offset."""
    index = spark.read.parquet(f"{folder}/index")
    cut = F.expr("substring(content, cast(offset + 1 as int), cast(length as int))")
    found = files(spark, folder).join(index, "chunk").select("doc_id", "offset", cut.alias("frame"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for batch in batches:
            got = [ids_of(next(frames(f + b"\n"))[1]) for f in batch["frame"].to_pylist()]
            yield rows_out(schema, {"doc_id": [k for k, _ in got],
                                    "ids": [ids.astype(np.int64) for _, ids in got]})

    return found.orderBy(F.xxhash64("doc_id", "offset", F.lit(seed))).mapInArrow(
        run, "doc_id long, ids array<long>")


@query("op2_token_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-records-{uuid.uuid4().hex}"
    written(table(spark, sf_dir, "documents"), folder, vocabulary_path())
    return read_back(spark, folder)
