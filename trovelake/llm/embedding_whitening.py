"""Whitening of embeddings by the leading eigenvectors of their covariance.

Four passes over the vectors, none of which shuffles them:

1. number of rows and exact sums of each dimension;
2. covariance of the centred rows: each task adds up products of its rows, the
   entries of the tasks' matrices are then added up by Spark;
3. covariance of the whitened rows, which tells how far it is from the identity;
4. whitened components, a row per vector and component.

Between them the driver holds d x d numbers (d dimensions; the bound is
``MOST_DIMENSIONS``): the covariance is brought to tridiagonal form by
Householder reflections, its leading eigenvalues are found by bisection on Sturm
counts, and their vectors by inverse iteration, reorthogonalised within clusters
of close eigenvalues, then reflected back. The projection (k x d) is broadcast.

Components are compared as whole numbers x = floor(1024 * c) + 100000.

* Vectors that are null, or hold a null or non-finite entry, take no part. Of
  vectors of different lengths those of the most common one (the longer, on a
  tie) take part. Whole numbers are kept within +-2^50.
* A null vec_id and rows that repeat are rows like others.
* Directions without variance (eigenvalue at most 1e-12 of the trace) are no
  components; a table without usable vectors, or of equal vectors, gives none.
* The sign of a component makes its largest entry (first of equal ones) positive.
* ``deviation`` is null where it does not fit a long.
* Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.llm.common import query, rows_out, table

COMPONENTS = 8
MOST_DIMENSIONS = 4096
BLOCK_ROWS = 4096
FLAT = 1e-12          # least share of the trace that counts as variance
EPS = np.finfo(np.float64).eps


# -- symmetric eigenproblem --------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections used, by
    Householder's method: reflection j clears column j below the subdiagonal."""
    a = matrix.copy()
    n, mirrors = len(a), []
    for j in range(n - 2):
        mirror = np.zeros(n)
        tail = a[j + 1:, j]
        size = np.linalg.norm(tail)
        if np.linalg.norm(tail[1:]) > 0:
            mirror[j + 1:] = tail
            mirror[j + 1] += np.copysign(size, tail[0])
            mirror /= np.linalg.norm(mirror)
            # (I - 2vv') A (I - 2vv') as a symmetric update of rank two
            p = a @ mirror
            q = p - (mirror @ p) * mirror
            a -= 2 * (np.outer(mirror, q) + np.outer(q, mirror))
        mirrors.append(mirror)
    return a.diagonal().copy(), a.diagonal(1).copy(), mirrors


def counts_below(diagonal: np.ndarray, beside: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each point: the
    negative terms of its Sturm sequence."""
    tiny = EPS * max(np.abs(diagonal).max(initial=0), np.abs(beside).max(initial=0)) + 1e-300
    count = np.zeros(len(points), dtype=np.int64)
    term = np.ones(len(points))
    for i in range(len(diagonal)):
        term = diagonal[i] - points - (beside[i - 1] ** 2 / term if i else 0.0)
        term = np.where(np.abs(term) < tiny, -tiny, term)
        count += term < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected to the last bit."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(beside)
    reach[1:] += np.abs(beside)
    edge = EPS * np.abs(diagonal).max() + 1e-300
    low = np.full(k, (diagonal - reach).min() - edge)
    high = np.full(k, (diagonal + reach).max() + edge)
    rank = n - 1 - np.arange(k)          # eigenvalue number, from 0 upwards
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = counts_below(diagonal, beside, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return np.sort(low + (high - low) / 2)[::-1]


def shifted_solve(diagonal: np.ndarray, beside: np.ndarray, shift: float,
                  right: np.ndarray, tiny: float) -> np.ndarray:
    """Solve (T - shift I) x = right by elimination with row exchanges."""
    n = len(diagonal)
    d, u = diagonal - shift, np.append(beside, 0.0)
    low, far, x = np.append(beside, 0.0), np.zeros(n), right.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low_i, u[i], d_next, far_i = low[i], d[i], d[i + 1], u[i], u[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i]
            factor = low_i / d[i]
            d[i + 1], u[i + 1], far[i] = d_next - factor * u[i], -factor * far_i, far_i
        else:
            if abs(d[i]) < tiny:
                d[i] = tiny
            factor = low[i] / d[i]
            d[i + 1] -= factor * u[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < tiny:
        d[-1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= u[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= far[i] * x[i + 2]
        x[i] /= d[i]
        if abs(x[i]) > 1e150:            # only the direction counts
            x /= abs(x[i])
    return x


def vectors_of(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling eigenvalues, by inverse iteration.

    Vectors of a cluster (values closer than 1e-3 of the norm) are kept
    orthogonal to those before them in each step.
    """
    n = len(diagonal)
    norm = np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0.0) + 1e-300
    rng = np.random.default_rng(n)
    found = np.zeros((len(values), n))
    cluster = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            cluster = i
        # equal values are told apart by the last bits
        shift = value - (i - cluster) * 4 * EPS * norm
        x = rng.standard_normal(n)
        for _ in range(6):
            x /= np.linalg.norm(x)
            x = shifted_solve(diagonal, beside, shift, x, EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):           # twice is enough
                x -= found[cluster:i].T @ (found[cluster:i] @ x)
        found[i] = x / np.linalg.norm(x)
    return found


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling) of a symmetric matrix and their unit
    eigenvectors as rows."""
    diagonal, beside, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, beside, min(k, len(matrix)))
    vectors = vectors_of(diagonal, beside, values)
    for mirror in reversed(mirrors):
        vectors -= 2 * np.outer(vectors @ mirror, mirror)
    largest = np.argmax(np.abs(vectors) > np.abs(vectors).max(axis=1, keepdims=True) * (1 - 1e-9),
                        axis=1)
    signs = np.sign(vectors[np.arange(len(vectors)), largest])
    return values, vectors * signs[:, None]


# -- passes over the vectors -----------------------------------------------------------

def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, embedding) of the vectors that may take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite & (F.size(vector) > 0)).select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """A batch's vectors as rows of whole numbers (as doubles, which hold them)."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(entries * 1024) + 100_000, -2.0**50, 2.0**50).reshape(-1, width)


def blocks_of(batches: Iterator[pa.RecordBatch],
              width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(start, BLOCK_ROWS)
            yield block, whole_numbers(block.column("embedding"), width)


@dataclass(frozen=True)
class Fit:
    n: int
    sums: np.ndarray        # exact, as Python numbers
    values: np.ndarray
    vectors: np.ndarray     # a row per component
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """Projection of centred rows: d x k."""
        return (self.vectors / np.sqrt(self.values)[:, None]).T

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums.tolist()], dtype=np.float64)


SUM_ROWS = pa.schema([("row", pa.int32()), ("column", pa.int32()), ("value", pa.float64())])
SUM_SCHEMA = "row int, column int, value double"


def added_up(rows: DataFrame, width: int, dimensions: int, of) -> np.ndarray:
    """Sum over all rows of block.T @ block, where ``of`` makes a block of
    ``width`` columns out of whole numbers. A task gives one matrix."""
    upper = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, numbers in blocks_of(batches, dimensions):
            block = of(numbers)
            total = block.T @ block if total is None else total + block.T @ block
        if total is not None:
            yield rows_out(SUM_ROWS, {"row": upper[0], "column": upper[1],
                                      "value": total[upper]})

    found = rows.mapInArrow(products, SUM_SCHEMA).groupBy("row", "column").agg(
        F.sum("value").alias("value")).toArrow()      # width * (width + 1) / 2 numbers
    matrix = np.zeros((width, width))
    matrix[found["row"], found["column"]] = found["value"]
    return matrix + np.triu(matrix, 1).T


def common_width(rows: DataFrame) -> int:
    """The most common length; 0 without rows."""
    best = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(
        F.desc("count"), F.desc("width")).first()
    return best["width"] if best else 0


def fit(rows: DataFrame, width: int, k: int) -> Fit | None:
    """Mean, leading eigenvalues and eigenvectors of the rows' covariance."""
    if width > MOST_DIMENSIONS:
        raise ValueError(f"{width} dimensions; at most {MOST_DIMENSIONS} are solved on the driver")
    schema = pa.schema([("place", pa.int32()), ("sum", pa.int64()), ("rows", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, numbers in blocks_of(batches, width):
            yield rows_out(schema, {
                "place": np.arange(width), "sum": numbers.astype(np.int64).sum(axis=0),
                "rows": np.full(width, block.num_rows)})

    found = rows.mapInArrow(sums, "place int, sum long, rows long").groupBy("place").agg(
        F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("rows").alias("rows")
    ).orderBy("place").collect()                      # a row per dimension
    if not found:
        return None
    n, totals = found[0]["rows"], np.array([int(r["sum"]) for r in found], dtype=object)
    start = Fit(n, totals, np.ones(1), np.ones((1, width)), 1.0)
    means = start.means
    covariance = added_up(rows, width, width, lambda numbers: numbers - means) / n
    trace = float(np.trace(covariance))
    if not trace > 0:
        return None
    values, vectors = leading_pairs(covariance / trace, k)
    real = values > FLAT
    return Fit(n, totals, values[real] * trace, vectors[real], trace)


def deviations(numbers: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    reach = max(abs(n * int(edge) - int(s)) for edges in (numbers.min(axis=0), numbers.max(axis=0))
                for edge, s in zip(edges, sums))
    if reach * reach * len(sums) < 1 << 62:
        away = n * numbers.astype(np.int64) - sums.astype(np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * numbers.astype(np.int64).astype(object) - sums
    return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()]


OUT_ROWS = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
    ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()),
    ("identity_error", pa.float64())])
OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")


def whitened(vectors: DataFrame, k: int = COMPONENTS, key: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    width = common_width(rows)
    rows = rows.where(F.size("embedding") == width)
    model = fit(rows, width, k) if width else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUT_SCHEMA)
    found = len(model.values)
    sent = spark.sparkContext.broadcast((model.n, model.sums, model.means, model.scales))

    def projected(numbers: np.ndarray) -> np.ndarray:
        _, _, means, scales = sent.value
        return (numbers - means) @ scales

    # a column of ones beside the components gives their sums
    joint = added_up(rows, found + 1, width, lambda numbers: np.hstack(
        [projected(numbers), np.ones((len(numbers), 1))])) / model.n
    mean = joint[:found, found]
    error = float(np.abs(joint[:found, :found] - np.outer(mean, mean) - np.eye(found)).max())
    explained = model.values / model.trace

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, _, _ = sent.value
        for block, numbers in blocks_of(batches, width):
            count = len(numbers)
            away = pa.array(deviations(numbers, n, sums), type=pa.int64())
            owner = pa.array(np.repeat(np.arange(count), found))
            yield rows_out(OUT_ROWS, {
                "vec_id": block.column("vec_id").take(owner),
                "component": np.tile(np.arange(1, found + 1), count),
                "n": np.full(count * found, n), "deviation": away.take(owner),
                "whitened": projected(numbers).ravel(), "explained": np.tile(explained, count),
                "identity_error": np.full(count * found, error)})

    return rows.mapInArrow(components, OUT_SCHEMA)


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
