"""Line dedup by content-defined chunks of lines.

The lines of a text are hashed; a rolling hash over the last ``ROLL`` line
hashes chooses where a chunk ends, so that boundaries depend on the lines around
them only and an inserted line shifts nothing behind it. A line of over
``LONG_WORDS`` words is a paragraph of its own and always forms a chunk. Where
the ends fall depends on the lines around a passage, so every two neighbouring
lines that are not blank are a chunk too, with the blank lines between them: a
repeated stretch of two or more lines is found whole, wherever it stands. Chunks
of two or more lines, and such paragraphs, that occur more than once in the
corpus (also within one document) are removed, except for the first occurrence
by (doc_id, position). Chunks overlap; a line goes only if an equal line stays
at an earlier place.

Chunks are compared by their bytes. A first pass counts 64-bit keys, and a
filter of fixed size drops beside the scan most chunks that occur once. The rest
are grouped by their digest and bytes, combined before the shuffle, so a chunk
that half of the corpus holds is one row per task. Only a digest that stands for
a single byte string leads to removal.
Decisions are spans per document; the texts meet them in one join.

* A null text stays null, an empty one empty. Documents without a removed chunk
  are returned byte for byte.
* Rows without a doc_id keep their text (nothing orders them).
* Rows that repeat a doc_id share its decisions: the same text is cut alike, and
  its first occurrence stays in each of them.
* Texts of any length are cut whole. Extra columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.llm.common import (
    CellFilter, as_bytes, few_rows, mixed, query, rows_out, table, worker_cache,
)
from trovelake.plans.settle import settled

ROLL = 2         # lines that the rolling hash covers
DIVISOR = 2      # a line ends a chunk if the rolling hash is divisible by this
LONG_WORDS = 50  # a line with more words is a chunk of its own
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
FILTER_CELLS = 1 << 24


def chunk_bounds(lines: list[bytes]) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, counts) of each chunk."""
    return bounds_of(lines, line_hashes(lines))


def line_hashes(lines: list[bytes]) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(line) for line in lines]


def bounds_of(lines: list[bytes], hashes: list[int]) -> list[tuple[int, int, bool]]:
    out, start, rolling = [], 0, 0
    drop = pow(BASE, ROLL, 1 << 64)
    for i, line in enumerate(lines):
        rolling = (rolling * BASE + hashes[i]) & MASK
        if i >= ROLL:
            rolling = (rolling - hashes[i - ROLL] * drop) & MASK
        if len(line.split()) > LONG_WORDS:
            if start < i:
                out.append((start, i, i - start >= 2))
            out.append((i, i + 1, True))
            start = i + 1
        elif (rolling ^ (rolling >> 29)) % DIVISOR == 0 and i > start:
            out.append((start, i + 1, True))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines), len(lines) - start >= 2))
    filled = [i for i, line in enumerate(lines) if line and not line.isspace()]
    known = {(a, b) for a, b, _ in out}
    out += [(i, j + 1, True) for i, j in zip(filled, filled[1:]) if (i, j + 1) not in known]
    return out


def chunk_keys(hashes: list[int], bounds: list[tuple[int, int, bool]]) -> np.ndarray:
    """64-bit key of each chunk, from the hashes of its lines."""
    if not bounds:
        return np.zeros(0, dtype=np.int64)
    own = np.array(hashes, dtype=np.uint64)
    first, last = (np.array([b[side] for b in bounds]) for side in (0, 1))
    keys = (last - first).astype(np.uint64)
    for place in range(int((last - first).max())):
        inside = first + place < last
        keys[inside] = mixed(keys[inside] * np.uint64(BASE) + own[first[inside] + place])
    return keys.view(np.int64)


CHUNKS = pa.schema([("doc_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                    ("digest", pa.binary()), ("chunk", pa.binary())])


def keys(documents: DataFrame) -> DataFrame:
    """(key) of every chunk that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("lines")  # frees what an operator before has left
        for batch in (few for whole in batches for few in few_rows(whole)):
            found = [np.zeros(0, dtype=np.int64)]
            for text in as_bytes(batch["text"]):
                lines = text.split(b"\n") if text else []
                hashes = line_hashes(lines)
                found.append(chunk_keys(hashes, [b for b in bounds_of(lines, hashes) if b[2]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["key"])

    return documents.where("doc_id is not null").select("text").mapInArrow(run, "key long")


def chunks(documents: DataFrame, passing: CellFilter) -> DataFrame:
    """(doc_id, first, last, digest, chunk) of the chunks that count and may
    occur more than once; lines first to last, both included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("lines")  # frees what an operator before has left
        passes = passing.test()
        for batch in (few for whole in batches for few in few_rows(whole)):
            out: dict[str, list] = {name: [] for name in CHUNKS.names}
            size = 0
            for key, text in zip(batch["doc_id"].to_pylist(), as_bytes(batch["text"])):
                lines = text.split(b"\n") if text else []
                hashes = line_hashes(lines)
                bounds = [b for b in bounds_of(lines, hashes) if b[2]]
                for at in np.flatnonzero(passes(chunk_keys(hashes, bounds))):
                    start, end, _ = bounds[at]
                    chunk = b"\n".join(lines[start:end])
                    if not chunk.strip():
                        continue
                    out["doc_id"].append(key)
                    out["first"].append(start)
                    out["last"].append(end - 1)
                    out["digest"].append(hashlib.md5(chunk).digest())
                    out["chunk"].append(chunk)
                    size += len(chunk)
                if size > 2_000_000:
                    yield rows_out(CHUNKS, out)
                    out, size = {name: [] for name in CHUNKS.names}, 0
            yield rows_out(CHUNKS, out)

    known = documents.where("doc_id is not null").select("doc_id", "text")
    return known.mapInArrow(
        run, "doc_id long, first int, last int, digest binary, chunk binary")


def repeated(found: DataFrame) -> DataFrame:
    """(digest, keep): chunks that occur more than once, with the first place."""
    place = F.struct("doc_id", "first")
    by_bytes = found.groupBy("digest", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("keep"))
    return by_bytes.groupBy("digest").agg(
        F.count(F.lit(1)).alias("byte_strings"), F.sum("n").alias("n"),
        F.min("keep").alias("keep"),
    ).where("byte_strings = 1 and n > 1").select("digest", "keep")


def removed_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, first, last, digest) of every chunk that is to be removed."""
    often = keys(documents).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    passing = CellFilter(often.select("key"), FILTER_CELLS)
    again = settled(repeated(chunks(documents, passing)))
    places = chunks(documents, passing).select("doc_id", "first", "last", "digest")
    return places.join(again, "digest").where(
        F.struct("doc_id", "first") != F.col("keep")
    ).select("doc_id", "first", "last", "digest")


def without(text: str | None, first, last, digest) -> tuple[str | None, int, int]:
    """The text without the given line spans, lines and words taken out.

    A span whose lines have another digest belongs to another row of that
    doc_id and is left alone.
    """
    if text is None or first is None:
        return text, 0, 0
    lines, drop = text.split("\n"), set()
    for start, end, wanted in zip(first, last, digest):
        chunk = "\n".join(lines[start:end + 1]).encode()
        if hashlib.md5(chunk).digest() == bytes(wanted):
            drop.update(range(start, end + 1))
    words = sum(len(lines[i].split()) for i in drop)
    return "\n".join(x for i, x in enumerate(lines) if i not in drop), len(drop), words


CUT = pa.struct([("text", pa.string()), ("removed_lines", pa.int64()),
                 ("removed_words", pa.int64())])


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents' columns with ``text`` cut, in a struct ``row``, beside
    doc_id, had_text, removed_lines and removed_words."""

    @F.arrow_udf("text string, removed_lines long, removed_words long")
    def cut(texts: pa.Array, first: pa.Array, last: pa.Array, digest: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays(
            [texts, first, last, digest], names=["text", "first", "last", "digest"])
        out = [pa.array([], type=CUT)]
        for few in few_rows(whole):
            rows = [without(*row) for row in zip(*(c.to_pylist() for c in few.columns))]
            out.append(pa.array([dict(zip(CUT.names, row)) for row in rows], type=CUT))
        return pa.concat_arrays(out)

    # a document has no more spans than chunks
    spans = removed_spans(documents).groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "last", "digest")).alias("spans"))
    rows = documents.select("doc_id", F.struct(*documents.columns).alias("row"))
    joined = rows.join(spans, "doc_id", "left").withColumn("cut", cut(
        "row.text", "spans.first", "spans.last", "spans.digest"))
    return joined.select(
        "doc_id", F.col("row").withField("text", F.col("cut.text")).alias("row"),
        (F.length("row.text") > 0).alias("had_text"),
        F.col("cut.removed_lines").alias("removed_lines"),
        F.col("cut.removed_words").alias("removed_words"))


@query("op7_line_chunks")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "removed_lines", "removed_words",
                      F.length("row.text").cast("long").alias("kept_chars"),
                      F.sha2(F.col("row.text"), 256).alias("text_sha256"))
