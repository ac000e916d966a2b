"""Quality classifier: an additive model with pairwise interactions.

The score of a text is the logistic of an intercept plus one table entry per
feature plus one per chosen pair of features. The tables are learned by cyclic
boosting: round after round, each feature in turn gets a small step of a shallow
tree over its bins, fitted to the current residuals; then the pairs whose grid
explains most of what is left get tables by two cuts each, in the same way. A
tree over bins is a lookup table, so trees are added up into one table per
feature, and scoring is binning and adding, vectorised over a batch.

Features are computed beside the scan in one pass over the bytes of a text. No
text, feature or score is shuffled; only the labelled rows for training are
joined. The model is fitted on at most ``TRAIN_ROWS`` labelled rows (those with
the smallest hash of doc_id), which bounds what reaches the driver.

* A null or empty text has all features 0 and gets a score like any other.
* A labelled document whose labels contradict each other, or are null, is not
  learned from. Without two classes to learn, every score is the share of label 1
  in training, or 0.5 without training rows.
* Repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trovelake.llm.common import (
    as_bytes, few_rows, held_out, query, rows_out, table, worker_cache,
)

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "punctuation", "symbols",
    "spaces", "newlines", "pipes", "sentence_ends", "distinct_words", "top_word",
    "repeated_next", "distinct_lines", "line_words", "capital_words", "marked_words",
    "shouting_ends",
]
TRAIN_ROWS = 20_000   # labelled rows that the model is fitted on, at most
BINS = 32
ROUNDS = 300
RATE = 0.1
PAIRS = 8             # pairs of features that get a table
PAIR_ROUNDS = 60
LEAST_ROWS = 5        # rows on each side of a cut
THRESHOLD = 0.3

SYMBOLS = b"#$%&*+<=>@\\^_`{|}~"
PUNCTUATION = b"!\"'(),-./:;?[]"


def features_of(text: bytes | None) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size = len(text)
    words = text.split()
    lines = text.split(b"\n")
    n = len(words) or 1
    by_word: dict[bytes, int] = {}
    for word in words:
        by_word[word] = by_word.get(word, 0) + 1
    marked = sum(k for w, k in by_word.items() if w[-1:] in b"#$%&*+=@^~" and len(w) > 1)
    shouted = sum(k for w, k in by_word.items() if w[-1:] == b"!")
    capital = sum(k for w, k in by_word.items() if len(w) > 1 and w.isupper())
    return [
        float(np.log1p(size)), float(np.log1p(len(words))), size / n,
        counts[65:91].sum() / size, counts[48:58].sum() / size,
        sum(int(counts[c]) for c in PUNCTUATION) / size,
        sum(int(counts[c]) for c in SYMBOLS) / size,
        counts[32] / size, counts[10] / size, counts[124] / n,
        (counts[46] + counts[63]) / n,
        len(by_word) / n, max(by_word.values(), default=0) / n,
        sum(a == b for a, b in zip(words, itertools.islice(words, 1, None))) / n,
        len(set(lines)) / len(lines), len(words) / len(lines),
        capital / n, marked / n, shouted / n,
    ]


@dataclass
class Model:
    """Cuts per feature, a table per feature, a grid per chosen pair."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, i], side="right")
                         for i, c in enumerate(self.cuts)], axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.intercept)
        if self.cuts and len(rows):
            bins = self.bins(rows)
            for i, values in enumerate(self.tables):
                total += values[bins[:, i]]
            for i, j, grid in self.pairs:
                total += grid[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def tree_step(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a shallow tree fitted to gradient sums per bin."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return out
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gains = gain(left_g, left_h) + gain(g.sum() - left_g, h.sum() - left_h)
    gains[(left_n < LEAST_ROWS) | (n.sum() - left_n < LEAST_ROWS)] = -np.inf
    cut = int(np.argmax(gains))
    if gains[cut] <= gain(g.sum(), h.sum()) + 1e-9:
        return out
    cut += 1
    return np.concatenate([tree_step(g[:cut], h[:cut], n[:cut], depth - 1),
                           tree_step(g[cut:], h[cut:], n[cut:], depth - 1)])


def pair_step(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree with one cut on each side of a grid, and its gain."""
    cg, ch, cn = (x.cumsum(0).cumsum(1) for x in (g, h, n))

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        a = c[:-1, :-1]
        top, left, whole = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, top - a, left - a, whole - top - left + a]

    qg, qh, qn = quarters(cg), quarters(ch), quarters(cn)
    gains = sum(gain(x, y) for x, y in zip(qg, qh))
    gains[np.minimum.reduce(qn) < LEAST_ROWS] = -np.inf
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.zeros_like(g)
    if not np.isfinite(gains[i, j]):
        return values, 0.0
    step = [x[i, j] / (y[i, j] + 1.0) for x, y in zip(qg, qh)]
    values[:i + 1, :j + 1], values[:i + 1, j + 1:] = step[0], step[1]
    values[i + 1:, :j + 1], values[i + 1:, j + 1:] = step[2], step[3]
    return values, float(gains[i, j])


def fitted(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Fit the model to a matrix of features and 0/1 labels."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or len(labels) < 2 * LEAST_ROWS:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))))
    model = Model(float(np.log(share / (1 - share))))
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(rows[:, i], points)) for i in range(rows.shape[1])]
    bins = model.bins(rows)
    sizes = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(s) for s in sizes]
    total = np.full(len(rows), model.intercept)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, size in enumerate(sizes):
            g, h = residuals()
            at = bins[:, i]
            step = RATE * tree_step(np.bincount(at, g, size), np.bincount(at, h, size),
                                    np.bincount(at, minlength=size))
            model.tables[i] += step
            total += step[at]

    def grid(i: int, j: int, weights: np.ndarray | None) -> np.ndarray:
        flat = bins[:, i] * sizes[j] + bins[:, j]
        return np.bincount(flat, weights, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = residuals()
    ranked = sorted(
        ((pair_step(grid(i, j, g), grid(i, j, h), grid(i, j, None))[1], i, j)
         for i, j in itertools.combinations(range(len(sizes)), 2)
         if sizes[i] > 1 and sizes[j] > 1), reverse=True)
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for _, i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, values in model.pairs:
            g, h = residuals()
            step = RATE * pair_step(grid(i, j, g), grid(i, j, h), grid(i, j, None))[0]
            values += step
            total += step[bins[:, i], bins[:, j]]
    return model


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    rows = [features_of(t) for few in few_rows(batch) for t in as_bytes(few["text"])]
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))


def trained(documents: DataFrame, labels: DataFrame, training=None) -> Model:
    """Learn from the labelled documents for which ``training`` holds."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    if training is not None:
        known = known.where(training)
    known = (
        known.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
        .select("doc_id", "quality")
    )
    # at most TRAIN_ROWS rows of two numbers
    examples = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("quality")
        for batch in batches:
            rows = matrix(batch)
            yield pa.RecordBatch.from_arrays(
                [batch["quality"].cast(pa.int32()), batch["doc_id"],
                 pa.array([r.tobytes() for r in rows], type=pa.binary())],
                names=["quality", "doc_id", "features"])

    # limit again: a doc_id may stand in several rows
    got = (examples.mapInArrow(run, "quality int, doc_id long, features binary")
           .orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(TRAIN_ROWS).toArrow())
    rows = np.frombuffer(b"".join(got["features"].to_pylist()), dtype=float)
    return fitted(rows.reshape(got.num_rows, len(FEATURES)),
                  np.array(got["quality"].to_pylist(), dtype=float))


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents, and ``score``; the model is a few tables."""
    assert "score" not in documents.columns
    schema = StructType([*documents.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.scores(matrix(batch)), type=pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score],
                                             names=[*batch.schema.names, "score"])

    return documents.mapInArrow(run, schema)


def accepted(documents: DataFrame, labels: DataFrame, training=None) -> DataFrame:
    """The documents that score at least THRESHOLD, with their columns.

    Only texts go to Python and only scores come back.
    """
    model = trained(documents, labels, training)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        worker_cache("quality")  # frees what an operator before has left
        rows = matrix(pa.RecordBatch.from_arrays([texts], names=["text"]))
        return pa.array(model.scores(rows), type=pa.float64())

    kept = documents.select(F.struct("*").alias("row"), score("text").alias("score"))
    return kept.where(F.col("score") >= THRESHOLD).select("row.*")


@query("op5_quality_gam")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(documents, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))
    return scored(documents, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
