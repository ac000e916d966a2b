"""Exact top-k search by inner product, with a KD-tree per shard.

Rows are dealt to shards by a hash of vec_id, so that a shard has a bounded
number of rows whatever values repeat. Each shard builds a KD-tree: median
splits on the widest side, each node with the tight box of its rows. A block of
queries meets a group of shards in one task. Going down a tree level by level,
the bound of a query to a box (the largest inner product that any point of the
box can have) drops the nodes that cannot reach the query's kth best score; the
leaves left are visited best bound first, and the kth score found so far is
carried from leaf to leaf and from shard to shard. The best rows of the groups
are then merged per query.

Components are compared as floor(64 * x). Scores are exact: products are added
in double precision where no sum can pass 2^53, and as whole numbers elsewhere,
held to the range of a long.

* Vectors that are null, or hold a null or non-finite component, take no part.
* Vectors of different length are not compared.
* ``vec_id`` is a key; of rows that repeat one, the vector that is smallest in
  array order stands. A null vec_id takes no part.
* Ties go to the smaller vec_id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, FloatType

from trovelake.llm.common import query, table

SHARD_ROWS = 4096      # rows of a shard, about
GROUP_SHARDS = 4       # shards that a task searches one after the other
BLOCK_QUERIES = 1024   # queries of a block, about
LEAF_ROWS = 128
K = 20
LONG = np.iinfo(np.int64)
HUGE = 1e300


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, a row per vec_id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    if rows.schema["embedding"].dataType != ArrayType(FloatType()):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min("embedding").alias("embedding"))


def whole_numbers(lists) -> np.ndarray:
    """floor(64 * x) of vectors of one length, exact as double (x is a double,
    and scaling by a power of two is exact unless it overflows)."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in lists])
    rows = rows.reshape(len(lists), -1)
    with np.errstate(over="ignore"):
        return np.floor(np.clip(rows * 64.0, -HUGE, HUGE))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as int64 (queries x rows)."""
    if not len(rows) or not len(queries):
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(rows.shape[1], 1)
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    exact = [[int(x) for x in r] for r in rows]
    out = [[min(max(sum(a * b for a, b in zip(q, r)), LONG.min), LONG.max) for r in exact]
           for q in ([int(x) for x in q] for q in queries)]
    return np.array(out, dtype=np.int64)


class Tree:
    """KD-tree of one shard: rows in leaf order, nodes level by level."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        self.levels: list[list[tuple[int, int]]] = [[(0, len(ids))]]
        while True:
            below, cut = [], False
            for start, end in self.levels[-1]:
                if end - start <= LEAF_ROWS:
                    below.append((start, end))
                    continue
                cut = True
                part = rows[order[start:end]]
                side = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if part.shape[1] else 0
                middle = (end - start) // 2
                if part.shape[1]:
                    order[start:end] = order[start:end][
                        np.argpartition(part[:, side], middle, kind="introselect")]
                below += [(start, start + middle), (start + middle, end)]
            if not cut:
                break
            self.levels.append(below)
        self.ids, self.rows = ids[order], rows[order]
        self.boxes = [
            (np.array([self.rows[a:b].min(axis=0) for a, b in level]),
             np.array([self.rows[a:b].max(axis=0) for a, b in level]))
            for level in self.levels]

    def leaf_bounds(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Upper bound of each query to each leaf; -inf where a node on the way
        down cannot reach the query's kth score."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        bounds = np.zeros((len(queries), 0))
        for level, (low, high) in enumerate(self.boxes):
            with np.errstate(over="ignore", invalid="ignore"):
                own = up @ high.T + down @ low.T
            own = np.nan_to_num(own, nan=HUGE, posinf=HUGE, neginf=-HUGE)
            own = own + np.abs(own) * 1e-9 + 1e-6  # rounded bounds must not fall short
            if level:
                own[np.isneginf(bounds[:, self._parents(level)])] = -np.inf
            own[own < kth[:, None]] = -np.inf
            bounds = own
        return bounds

    def _parents(self, level: int) -> np.ndarray:
        starts = [a for a, _ in self.levels[level - 1]]
        return np.searchsorted(starts, [a for a, _ in self.levels[level]], side="right") - 1


def best(owner: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    """The k best of each owner, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, owner))  # ~ turns the order round without overflow
    owner, scores, ids = owner[order], scores[order], ids[order]
    first = np.searchsorted(owner, owner, side="left")
    keep = np.arange(len(owner)) - first < k
    return owner[keep], scores[keep], ids[keep]


def searched(tree: Tree, queries: np.ndarray, query_ids: np.ndarray, state, k: int):
    """Search one shard for a block of queries, starting from ``state``.

    ``state``: (owner, score, id) arrays of the best so far. Visits the leaves
    of each query best bound first, one leaf of every query in turn.
    """
    owner, scores, ids = state

    def kth() -> np.ndarray:
        out = np.full(len(queries), -np.inf)
        count = np.bincount(owner, minlength=len(queries))
        last = np.cumsum(count) - 1
        full = count >= k
        out[full] = np.nextafter(scores[last[full]].astype(float), -np.inf)
        return out

    reach = kth()
    bounds = tree.leaf_bounds(queries, reach)
    order = np.argsort(-bounds, axis=1, kind="stable")
    leaves = tree.levels[-1]
    for turn in range(len(leaves)):
        at = order[:, turn]
        bound = bounds[np.arange(len(queries)), at]
        # equal to the kth score may still win by a smaller vec_id
        asking = np.flatnonzero(~np.isneginf(bound) & (bound >= reach))
        if not len(asking):
            break
        new = []
        for leaf in np.unique(at[asking]):
            who = asking[at[asking] == leaf]
            start, end = leaves[leaf]
            got = products(queries[who], tree.rows[start:end])
            hit = (got >= reach[who][:, None]) & (
                tree.ids[start:end][None, :] != query_ids[who][:, None])
            q, r = np.nonzero(hit)
            new.append((who[q], got[q, r], tree.ids[start:end][r]))
        owner, scores, ids = best(
            *(np.concatenate([old, *(n[i] for n in new)])
              for i, old in enumerate((owner, scores, ids))), k)
        reach = kth()
    return owner, scores, ids


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The k best rows of all other rows for each row that ``is_query`` holds for.

    Returns query_id, rank (from 1), vec_id, score.
    """
    rows = usable(vectors).withColumn("length", F.size("embedding"))
    total = rows.count()
    shards = max(1, -(-total // SHARD_ROWS))
    groups = max(1, -(-shards // GROUP_SHARDS))
    asked = rows.where(is_query)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    # a block of queries against all rows, in blocks: every row goes to each block
    candidates = rows.select(
        "vec_id", "embedding", "length", shard.alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    ).withColumn("group", F.pmod("shard", F.lit(groups)))
    queries = asked.select(
        "vec_id", "embedding", "length", block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))

    def run(key, asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: np.zeros(0, dtype=np.int64)
                             for c in ("query_id", "vec_id", "score")})
        if asking.empty or there.empty:
            return none
        points = whole_numbers(asking["embedding"].tolist())
        query_ids = asking["vec_id"].to_numpy()
        state = (np.zeros(0, dtype=np.int64),) * 3
        for _, part in there.groupby("shard", sort=True):
            tree = Tree(part["vec_id"].to_numpy(), whole_numbers(part["embedding"].tolist()))
            state = searched(tree, points, query_ids, state, k)
        owner, scores, ids = state
        return pd.DataFrame({"query_id": query_ids[owner], "vec_id": ids, "score": scores})

    found = (
        queries.groupBy("block", "group", "length")
        .cogroup(candidates.groupBy("block", "group", "length"))
        .applyInPandas(run, "query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op1_kd_search")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
