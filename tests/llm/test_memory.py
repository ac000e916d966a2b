"""What a task holds beside its batch."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import zstandard

from trovelake.llm import line_chunks, quality_gam, shingle_join
from trovelake.llm.common import CellFilter

TEXTS = [" ".join(f"w{i}x{j}" for j in range(250)) for i in range(4000)]
BATCH = pa.RecordBatch.from_pydict({"doc_id": range(4000), "text": TEXTS})


class Task:
    """A table whose ``mapInArrow`` runs here, over one batch."""

    def select(self, *columns):
        return self

    where = select

    def mapInArrow(self, run, schema):
        return run(iter([BATCH]))


def peak_mb(work) -> float:
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_sketch_and_sets_of_a_task_are_small():
    def work():
        for _ in shingle_join.keyed(Task()):
            pass

    assert peak_mb(work) < 70  # with 35 for remembered words


def test_sketches_add_up_to_all_shingles(monkeypatch):
    monkeypatch.setattr(shingle_join, "SKETCHED", 1500)
    rows = [r for b in shingle_join.keyed(Task()) for r in b.to_pylist()]
    docs = [r for r in rows if r["part"] is None]
    parts = [r for r in rows if r["part"] is not None]
    assert [r["doc_id"] for r in docs] == list(range(4000))
    assert len(parts) == 3 * shingle_join.CELLS // shingle_join.PART
    counts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(r["counts"]), dtype=np.uint16)
              for r in parts]
    assert sum(int(c.sum()) for c in counts) == sum(r["n_shingles"] for r in docs)


def test_features_are_made_of_few_texts_at_a_time():
    assert peak_mb(lambda: quality_gam.matrix(BATCH)) < 6


def test_chunks_are_keyed_for_few_texts_at_a_time():
    def work():
        for _ in line_chunks.keys(Task()):
            pass

    assert peak_mb(work) < 4


def test_filter_keeps_its_cells_packed(spark):
    numbers = spark.createDataFrame([(n,) for n in (-7, 0, 5, 1 << 40)], "n long")
    test = CellFilter(numbers, 1 << 24).test
    kept = []
    assert peak_mb(lambda: kept.append(test())) < 10
    tried = np.array([-8, -7, 0, 1, 5, 6, 7, 1 << 40, (1 << 40) + 1, 5 - (1 << 24)])
    assert kept[0](tried).tolist() == [
        False, True, True, False, True, False, False, True, False, True]
    assert kept[0](tried.astype(np.uint64)).tolist() == kept[0](tried).tolist()
