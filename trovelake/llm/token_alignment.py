"""Which tokens of two tokenizers cover the same bytes.

A text is encoded by tokenizer A (byte-level BPE, a space put before the text)
and by tokenizer B (pieces, which puts the space itself). Tokens and bytes, and
groups and tokens, form incidence matrices in CSR form (row starts and column
numbers); tokens partition the bytes, so a row holds a run of columns. Gustavson
row products give the links:

* A . B^T over bytes: token pairs that overlap, with the number of shared bytes;
* of these, the pairs that end together;
* G_A^T . G_B over groups: pairs in one group. Groups are what the byte offsets
  at which tokens of both end cut the text into.

A product runs over segments of the bytes, cut at group ends, so its memory does
not depend on the length of a text (a text that forms one group is one segment).

``links`` returns links of one of the three kinds. ``aligned`` returns a row per
document with its digest and how well its end links agree with the corpus: the
links of a chunk of documents are kept as places in the chunk's list of distinct
(A id, B id) pairs; only the lists are exploded, counted over the corpus, and
joined back. Chunks are written to the shared folder first, so that texts are
encoded once.

* A text that is null or empty, or whose bytes the tokens of A or B do not give
  back (piece normalisation), has no tokens: zeros and an empty digest.
* Rows that repeat, also with equal or null doc_id, are answered each.
* Extra columns are not read. An empty table gives an empty result.
* The strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trovelake.llm.common import query, rows_out, table, worker_cache
from trovelake.plans.settle import settled

CHUNK_BYTES = 4 << 20     # text of a chunk, about
SEGMENT_BYTES = 1 << 18   # bytes of one product, about
# Letters that the two libraries of tokenizer A classify alike; a text with any
# other character is left to the one that defines the result.
PLAIN = re.compile(r"[\x00-ɏͰ-ͳΆ-ώЀ-ҁҊ-ԯ"
                   r"‐-‧ぁ-ゖァ-ヺ一-龥]*")


# -- incidence matrices ----------------------------------------------------------

@dataclass(frozen=True)
class Incidence:
    """A 0/1 matrix: row r has ones in the columns ``indices[starts[r]:starts[r + 1]]``."""

    starts: np.ndarray
    indices: np.ndarray
    columns: int

    @classmethod
    def runs(cls, ends: np.ndarray) -> Incidence:
        """Rows that split the columns 0, 1, ... into runs with these ends."""
        total = int(ends[-1]) if len(ends) else 0
        return cls(np.concatenate([[0], ends]), np.arange(total), total)

    def rows_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Incidence:
        order = np.argsort(self.indices, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Incidence(starts, self.rows_of_entries()[order], len(self.starts) - 1)


def product(left: Incidence, right: Incidence) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row, column, value) of left . right, in order.

    Gustavson's rule for all rows at once: each entry of a left row brings the
    right row it names, and equal columns brought to one row are added up.
    """
    widths = np.diff(right.starts)[left.indices]
    shift = right.starts[left.indices] - (np.cumsum(widths) - widths)
    columns = right.indices[np.repeat(shift, widths) + np.arange(int(widths.sum()))]
    cell = np.repeat(left.rows_of_entries(), widths) * right.columns + columns
    if len(cell) and (cell[1:] < cell[:-1]).any():
        cell.sort()
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])[:len(cell)])
    values = np.diff(np.concatenate([first, [len(cell)]]))
    return cell[first] // max(right.columns, 1), cell[first] % max(right.columns, 1), values


# -- tokenizers --------------------------------------------------------------------

class Tokenizers:
    """Both tokenizers in a worker, with the bytes of every id."""

    def __init__(self, a_path: str, ranks_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
        self.a_path, self.slow = a_path, None
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks,
                                      special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        size = max(ranks.values()) + 1
        self.a_bytes = [b""] * (size + 1)
        for token, number in ranks.items():
            self.a_bytes[number] = token
        self.b_bytes = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number)
                                else piece.replace("▁", " ").encode())
        self.a_lengths = np.array([len(t) for t in self.a_bytes])
        self.b_lengths = np.array([len(t) for t in self.b_bytes])
        # an id as text with the sign that follows it: inside a list, at its end
        self.words = [f"{i}{sign}".encode() for n, signs in (
            (len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for sign in signs
            for i in range(n)]

    def encoded_a(self, text: str) -> list[int]:
        if PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.a_path)
            self.slow.encode_special_tokens = True
            self.slow.no_truncation()
            self.slow.no_padding()
        return self.slow.encode(text, add_special_tokens=False).ids

    def both(self, text: str | None) -> tuple[list[int], list[int], bytes]:
        """Ids of A and of B, and the bytes both cover; nothing if they do not."""
        if not text:
            return [], [], b""
        spaced = " " + text
        whole = spaced.encode()
        a, b = self.encoded_a(spaced), self.pieces.encode(text)
        for ids, known in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(known.__getitem__, ids)) != whole:
                return [], [], b""
        return a, b, whole


def tokenizers(paths: tuple[str, str, str, str]) -> Tokenizers:
    cache = worker_cache("alignment")
    if paths not in cache:
        cache[paths] = Tokenizers(*paths)
    return cache[paths]


def public_paths() -> tuple[str, str, str, str]:
    """Vocabulary of A, its ranks, the model of B, and A's splitting pattern."""
    import public_tokenizers as public

    return (public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"),
            public.path("piece_bpe_32k.model"), public.PATTERN)


# -- a chunk of documents ------------------------------------------------------------

class Chunk:
    """The tokens of some documents, end to end, and their links."""

    def __init__(self, known: Tokenizers, texts: list[str | None]):
        self.known = known
        a, b, covered = [], [], []
        for text in texts:
            ids_a, ids_b, whole = known.both(text)
            a.append(np.array(ids_a, dtype=np.int32))
            b.append(np.array(ids_b, dtype=np.int32))
            covered.append(len(whole))
        self.n_a, self.n_b = (np.array([len(ids) for ids in side]) for side in (a, b))
        none = np.zeros(0, dtype=np.int32)
        self.a, self.b = np.concatenate([none, *a]), np.concatenate([none, *b])
        self.a_ends = np.cumsum(known.a_lengths[self.a])
        self.b_ends = np.cumsum(known.b_lengths[self.b])
        self.document_ends = np.cumsum(covered)
        self.group_ends = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        # rows of the group incidence: tokens of A, of B, up to each group's end
        self.groups_a = np.searchsorted(self.a_ends, self.group_ends) + 1
        self.groups_b = np.searchsorted(self.b_ends, self.group_ends) + 1

    def per_document(self, ends: np.ndarray) -> np.ndarray:
        """How many of the (sorted) byte offsets each document has."""
        return np.diff(np.searchsorted(ends, self.document_ends, side="right"), prepend=0)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes), segment by segment."""
        if not len(self.group_ends):
            return
        aims = np.arange(SEGMENT_BYTES, self.group_ends[-1], SEGMENT_BYTES)
        cuts = self.group_ends[np.searchsorted(self.group_ends, aims)]
        start = 0
        for end in np.unique(np.append(cuts, self.group_ends[-1])):
            a0, a1 = np.searchsorted(self.a_ends, [start, end], side="right")
            b0, b1 = np.searchsorted(self.b_ends, [start, end], side="right")
            of_a = Incidence.runs(self.a_ends[a0:a1] - start)
            of_b = Incidence.runs(self.b_ends[b0:b1] - start)
            rows, columns, shared = product(of_a, of_b.transposed())
            yield rows + a0, columns + b0, shared
            start = end

    def end_links(self) -> tuple[np.ndarray, np.ndarray]:
        """Overlapping tokens that end together."""
        found = [(i[same], j[same]) for i, j, _ in self.overlaps()
                 for same in [self.a_ends[i] == self.b_ends[j]]]
        none = np.zeros(0, dtype=np.int64)
        return (np.concatenate([none, *(i for i, _ in found)]),
                np.concatenate([none, *(j for _, j in found)]))

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A token, B token) in one group, some groups at a time."""
        step = 4096
        for low in range(0, len(self.group_ends), step):
            first_a, first_b = (int(g[low - 1]) if low else 0
                                for g in (self.groups_a, self.groups_b))
            of_a = Incidence.runs(self.groups_a[low:low + step] - first_a)
            of_b = Incidence.runs(self.groups_b[low:low + step] - first_b)
            rows, columns, _ = product(of_a.transposed(), of_b)
            yield rows + first_a, columns + first_b

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        known, width_a = self.known, len(self.known.a_bytes)
        before_a = np.concatenate([[0], self.groups_a])
        before_b = np.concatenate([[0], self.groups_b])
        group_a = np.searchsorted(self.group_ends, self.a_ends)
        group_b = np.searchsorted(self.group_ends, self.b_ends)
        last_a = np.zeros(len(self.a), dtype=np.int64)
        last_b = np.zeros(len(self.b), dtype=np.int64)
        last_a[self.groups_a - 1] = width_a
        last_b[self.groups_b - 1] = len(known.b_bytes)
        # a group's A tokens, then its B tokens
        line = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        line[np.arange(len(self.a)) + before_b[group_a]] = self.a + last_a
        line[np.arange(len(self.b)) + before_a[group_b + 1]] = self.b + last_b + 2 * width_a
        out, start = [], 0
        for end in np.cumsum(self.n_a + self.n_b).tolist():
            text = b"".join(map(known.words.__getitem__, line[start:end].tolist()))
            out.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
            start = end
        return out


def chunks_of(batches: Iterator[pa.RecordBatch], known: Tokenizers) -> Iterator[tuple[list, Chunk]]:
    """Documents of a task in chunks of about CHUNK_BYTES."""
    ids: list = []
    texts: list = []
    size = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(key)
            texts.append(text)
            size += len(text) if text else 0
            if size >= CHUNK_BYTES or len(ids) >= 50_000:
                yield ids, Chunk(known, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield ids, Chunk(known, texts)


# -- over the corpus -------------------------------------------------------------------

LONGS = pa.list_(pa.int64())
CHUNK_ROWS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", LONGS), ("n_a", LONGS), ("n_b", LONGS),
    ("n_groups", LONGS), ("n_links", LONGS), ("groups_sha256", pa.list_(pa.string())),
    ("pair", LONGS), ("times", LONGS), ("places", pa.binary())])
CHUNK_SCHEMA = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, "
                "n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
                "pair array<long>, times array<long>, places binary")
DOCUMENT_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
    ("groups_sha256", pa.string())])
DOCUMENT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                   "count_sum long, groups_sha256 string")
LINK_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("a_place", pa.int64()), ("b_place", pa.int64()),
    ("a_id", pa.int64()), ("b_id", pa.int64())])


def documents_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def links(docs: DataFrame, kind: str, paths: tuple[str, str, str, str] | None = None) -> DataFrame:
    """All links of a kind ("overlap", "end" or "group") as (doc_id, a_place,
    b_place, a_id, b_id); places count a document's tokens from 0."""
    assert kind in ("overlap", "end", "group"), kind
    paths = paths or public_paths()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in chunks_of(batches, tokenizers(paths)):
            if kind == "end":
                found = iter([chunk.end_links()])
            elif kind == "group":
                found = chunk.group_links()
            else:
                found = ((i, j) for i, j, _ in chunk.overlaps())
            first_a, first_b = (np.cumsum(n) - n for n in (chunk.n_a, chunk.n_b))
            for i, j in found:
                owner = np.searchsorted(np.cumsum(chunk.n_a), i, side="right")
                yield rows_out(LINK_ROWS, {
                    "doc_id": [ids[k] for k in owner.tolist()], "a_place": i - first_a[owner],
                    "b_place": j - first_b[owner], "a_id": chunk.a[i], "b_id": chunk.b[j]})

    return documents_of(docs).mapInArrow(
        linked, "doc_id long, a_place long, b_place long, a_id long, b_id long")


def encoded_chunks(docs: DataFrame, paths: tuple[str, str, str, str]) -> DataFrame:
    """A row per chunk: its documents, its distinct pairs, and its end links as
    places in the list of pairs."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known, number = tokenizers(paths), TaskContext.get().partitionId() << 32
        for ids, chunk in chunks_of(batches, known):
            i, j = chunk.end_links()
            pairs = chunk.a[i].astype(np.int64) * len(known.b_bytes) + chunk.b[j]
            pair, place, times = np.unique(pairs, return_inverse=True, return_counts=True)
            small = np.uint16 if len(pair) <= 1 << 16 else np.uint32
            yield rows_out(CHUNK_ROWS, {
                "chunk": [number], "doc_id": [ids], "n_a": [chunk.n_a], "n_b": [chunk.n_b],
                "n_groups": [chunk.per_document(chunk.group_ends)],
                "n_links": [chunk.per_document(chunk.a_ends[i])],
                "groups_sha256": [chunk.digests()], "pair": [pair], "times": [times],
                "places": [zstandard.ZstdCompressor(1).compress(place.astype(small).tobytes())]})
            number += 1

    return documents_of(docs).mapInArrow(chunked, CHUNK_SCHEMA)


def aligned(docs: DataFrame, paths: tuple[str, str, str, str] | None = None) -> DataFrame:
    """One row per document: tokens of A and B, groups, end links, how many of
    these are the best of their B id in the corpus, and the sum of their counts.
    """
    paths = paths or public_paths()
    width = pieces_in(paths[2])
    chunks = settled(encoded_chunks(docs, paths))
    counts = chunks.select(F.explode(F.arrays_zip("pair", "times")).alias("p")).groupBy(
        F.col("p.pair").alias("pair")).agg(F.sum("p.times").alias("total"))
    # an id of B has at most as many pairs as A has ids, so this window is bounded
    of_b = W.partitionBy(F.col("pair") % width)
    scored = counts.withColumn("best", F.col("total") == F.max("total").over(of_b))
    asked = chunks.select(F.col("chunk").alias("of_chunk"), F.posexplode("pair").alias(
        "place", "pair")).join(scored, "pair").select("of_chunk", "place", "total", "best")

    def answered(key, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        n = right.num_rows
        total, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        place = right["place"].to_numpy()
        total[place] = right["total"].to_numpy()
        best[place] = right["best"].to_numpy(zero_copy_only=False)
        row = left.slice(0, 1)
        found = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["places"][0].as_py()),
                              dtype=np.uint16 if n <= 1 << 16 else np.uint32)
        columns = {c: row[c].chunk(0).values for c in (
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        ends = np.concatenate([[0], np.cumsum(columns["n_links"].to_numpy())])
        for name, values in (("n_best", best), ("count_sum", total)):
            sums = np.concatenate([[0], np.cumsum(values[found])])[ends]
            columns[name] = np.diff(sums)
        return pa.Table.from_batches([rows_out(DOCUMENT_ROWS, columns)])

    return chunks.drop("pair", "times").groupBy("chunk").cogroup(
        asked.groupBy("of_chunk")).applyInArrow(answered, DOCUMENT_SCHEMA)


def pieces_in(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))
