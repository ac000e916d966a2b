"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can express it."""

    def keep(run):
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over its tasks.

    Functions sent by value have no module in the worker to keep it in. Asking
    for one name drops the others: a worker remembers for one operator at a time,
    and what the one before has left goes back to the system.
    """
    holder = sys.modules.setdefault("_trovelake_worker", types.ModuleType("_trovelake_worker"))
    kept = holder.__dict__.setdefault("kept", {})
    if name not in kept:
        dropped = bool(kept)
        kept.clear()
        kept[name] = {}
        if dropped:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)
    return kept[name]


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``, equals ``remainder``."""
    return F.crc32(F.col(key).cast("string")) % modulus == remainder


def ascii_lower(column: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def few_rows(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, so that what is made of texts is held for one run."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` splits at exactly
    0x20 and 0x09-0x0D.
    """
    return text.lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), so that every input bit reaches all."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` items of a uint64 array, in order.

    An array shorter than that is hashed as one run; an empty one gives none.
    """
    if not len(items):
        return items
    width = min(width, len(items))
    count = len(items) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for place in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + items[place:place + count])
    return total


class CellFilter:
    """A fixed-size filter of whole numbers, to test beside a scan.

    It lets every number of the set through, and others that share a cell with
    one. Its size does not depend on the set: at most ``cells`` numbers reach
    the driver, and a large set only lets more through.
    """

    def __init__(self, numbers: DataFrame, cells: int = 1 << 22):
        column = F.pmod(F.col(numbers.columns[0]), F.lit(cells)).cast("int")
        found = numbers.select(column.alias("cell")).where("cell is not null").distinct().toArrow()
        marks = np.zeros(cells, dtype=bool)
        marks[found["cell"].to_numpy()] = True
        self.cells = cells
        self.sent = numbers.sparkSession.sparkContext.broadcast(np.packbits(marks).tobytes())

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """In a task: whole numbers -> whether they may be of the set. The cells
        stay packed, eight to a byte."""
        packed = np.frombuffer(self.sent.value, dtype=np.uint8)

        def passes(numbers: np.ndarray) -> np.ndarray:
            cells = (numbers % numbers.dtype.type(self.cells)).astype(np.int64)
            return (packed[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1

        return passes


class WordHashes(dict):
    """word -> 64-bit hash; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def word_hashes() -> WordHashes:
    cache = worker_cache("words")
    if "hashes" not in cache:
        cache["hashes"] = WordHashes()
    return cache["hashes"]


def rows_out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
