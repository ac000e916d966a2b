"""Mixing sources to target weights by Pareto order sampling.

The size of a document is its number of words. Each source has a target of words;
targets share a total by weight and stop at ``MOST`` times the source's size, the
excess being shared again by weight.

Within a source each document has an expected number of copies: in proportion to
1 / (documents of the source with its text), so that copies of a text share the
place of one, held to ``MOST``, and such that expected words add up to the
target. Its whole part is certain. The rest, a probability p, is sampled:
documents are ranked by the Pareto order, (u / (1 - u)) / (p / (1 - p)) with u a
random number from the seed, doc_id and text, and taken in that order as long as
the words left to the source's target last. A few documents next to the cut are
taken or exchanged (``closers``) to fill the gap that the cut leaves, which is less
than one document.

The cut is found as in a radix sort: words are summed by the upper bits of the
rank, then by the middle bits within the bin that the cut falls in, and only the
documents of one small bin per source are put in order. No source, text or table
passes through one task.

* A null or empty text has size 0, is never taken, and is answered with zeros. A
  null source is a source, last in order.
* Rows with equal doc_id and text are copies with one rank: if the cut falls among
  them, as many of them are taken as fit.
* Ties in rank go by a hash of doc_id and text. Reruns give the same rows.
* Extra columns are not read; ``written`` keeps them. An empty table gives an
  empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trovelake.llm.common import query, table
from trovelake.plans.settle import settled
from trovelake.plans.skew import numbered, positioned

MOST = 3               # copies of a document, and times a source's size
WEIGHTS = (1, 2, 3)    # of the sources in order, repeating
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
CLOSERS = 8            # documents of a doubling of size that may close the gap
EXCHANGES = 3          # of documents next to the cut, at most, per source
RANK_STEPS = 2.0**40   # ranks in a unit of log odds
COARSE, FINE = 34, 16  # bits of the rank below the two levels of bins
EXACT = "decimal(38,12)"


def identity(docs: DataFrame) -> Column:
    """Of a row's doc_id and text."""
    return F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.md5(F.coalesce("text", F.lit("")))))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_key, key, part, place), a narrow row per document."""
    return settled(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
        .cast("long").alias("size"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), identity(docs).alias("key"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))


# -- sharing an amount by weight -------------------------------------------------------

def levels(parts: DataFrame) -> DataFrame:
    """(group, level) for ``parts`` with group, weight, room and amount (one per
    group): each part gets least(weight * level, room), which add up to the
    amount or to all room.

    Parts that are full at one level stay full at the next, higher one, so the
    number of full parts, the only thing the driver sees, grows until it is right.
    Sums are of whole numbers or decimals, so reruns agree to the last bit.
    """
    parts = settled(parts)
    known, full_before = None, -1
    while True:
        if known is None:
            judged = parts.withColumn("full", F.lit(False))
        else:
            judged = parts.join(known, "group").withColumn(
                "full", F.col("room") <= F.col("weight").cast("double") * F.col("level"))
        left = F.first("amount") - F.coalesce(
            F.sum(F.when(F.col("full"), F.col("room"))), F.lit(0)).cast("double")
        weight = F.sum(F.when(~F.col("full"), F.col("weight"))).cast("double")
        known = settled(judged.groupBy("group").agg(
            F.when(weight > 0, left / weight).otherwise(float("inf")).alias("level"),
            F.count_if("full").alias("n")))
        full = known.agg(F.sum("n")).first()[0] or 0
        known = known.drop("n")
        if full == full_before:
            return known
        full_before = full


def share(weight: Column, room: Column) -> Column:
    """What a part gets at its group's level."""
    return F.least(weight.cast("double") * F.col("level"), room.cast("double"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_no, source_size, target) of every source."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = settled(positioned(sizes, [F.col("source").asc_nulls_last()], "source_no"))
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    weight = F.element_at(F.array(*map(F.lit, weights)), (
        F.col("source_no") % len(weights) + 1).cast("int")).cast("long")
    parts = placed.select("*", F.lit(0).alias("group"), weight.alias("weight"),
                          (F.col("source_size") * MOST).alias("room"),
                          F.lit(float(total)).alias("amount"))
    return settled(parts.join(levels(parts), "group").select(
        "source", "source_no", "source_size",
        share(F.col("weight"), F.col("room")).alias("target")))


# -- ranks and the cut -------------------------------------------------------------------

def ranked(rows: DataFrame, mix: DataFrame) -> DataFrame:
    """Rows with their source's target, certain copies, and rank (null where
    nothing is left to chance)."""
    joined = rows.join(mix, rows["source"].eqNullSafe(mix["source"])).drop(mix["source"])
    same = ["source_no", "text_key"]
    repeated = joined.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = settled(joined.join(repeated, same, "left").withColumn(
        "n", F.coalesce("n", F.lit(1).cast("long"))).drop("text_key"))
    words = F.sum("size")
    classes = joined.where("size > 0").groupBy(F.col("source_no").alias("group"), "n").agg(
        (words.cast("decimal(20,0)") / F.col("n").cast("decimal(20,0)")).cast(EXACT)
        .alias("weight"), (words * MOST).alias("room"), F.first("target").alias("amount"))
    expected = F.least(F.lit(float(MOST)), F.col("level") / F.col("n"))
    rows = joined.join(levels(classes).withColumnRenamed("group", "source_no"),
                       "source_no", "left").withColumn(
        "expected", F.when(F.col("size") > 0, expected).otherwise(0.0)).drop("level", "n")
    rows = rows.withColumn("whole", F.floor("expected"))
    p = F.col("expected") - F.col("whole")
    u = (F.conv(F.substring("key", 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    odds = (u / (1 - u)) / (p / (1 - p))
    return settled(rows.withColumn("rank", F.when(
        p > 0, F.floor(F.log(odds) * RANK_STEPS)).cast("long")))


def crossed(sums: DataFrame, order: list[str]) -> DataFrame:
    """Of (source_no, rest, order ..., words): the first row of each source whose
    words, added up in order, exceed ``rest``, with ``before``."""
    upto = W.partitionBy("source_no").orderBy(*order)
    added = sums.withColumn("through", F.sum("words").over(upto)).withColumn(
        "before", F.col("through") - F.col("words")).where(F.col("through") > F.col("rest"))
    first = F.row_number().over(upto)
    return added.withColumn("row", first).where("row = 1").drop("row", "through")


def cuts(rows: DataFrame) -> DataFrame:
    """(source_no, cut_rank, cut_key, cut_rows, gap): rows before (cut_rank,
    cut_key) are taken, and ``cut_rows`` of the rows there. Sources whose chance
    rows all fit have no row."""
    rest = rows.groupBy("source_no", "target").agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain")).select(
        "source_no", (F.col("target") - F.col("certain")).alias("rest"))
    chances = rows.where("rank is not null")
    found = rest
    for name, bits in (("coarse", COARSE), ("fine", FINE)):
        # a source has few bins of a level, whatever the number of its rows
        in_bin = chances.withColumn(name, F.shiftright("rank", bits))
        sums = in_bin.groupBy("source_no", name).agg(F.sum("size").alias("words")).join(
            found, "source_no")
        found = settled(crossed(sums, [name]).select(
            "source_no", name, (F.col("rest") - F.col("before")).alias("rest")))
        chances = in_bin.join(found.select("source_no", name), ["source_no", name], "left_semi")
    groups = chances.groupBy("source_no", "rank", "key", "size").agg(
        (F.count(F.lit(1)) * F.col("size")).alias("words")).join(
        found.select("source_no", "rest"), "source_no")
    left = F.col("rest") - F.col("before")
    at = crossed(groups, ["rank", "key"]).withColumn("cut_rows", F.floor(left / F.col("size")))
    return settled(at.select(
        "source_no", F.col("rank").alias("cut_rank"), F.col("key").alias("cut_key"), "cut_rows",
        (left - F.col("cut_rows") * F.col("size")).alias("gap")))


def closers(rows: DataFrame, at: DataFrame) -> DataFrame:
    """(source_no, rank, key, quota): documents near the cut that are taken or
    left out to fill the gap it leaves.

    Of each doubling of size the ``CLOSERS`` documents next to the cut stand for
    election, on both sides. The exchange of two (or the one document to take or
    leave out) that comes nearest to what is missing is made, a few times.
    """
    place = F.struct("rank", "key")
    cut = F.struct(F.col("cut_rank").alias("rank"), F.col("cut_key").alias("key"))
    chances = rows.where("rank is not null").join(at, "source_no")
    groups = chances.groupBy("source_no", "rank", "key", "size", "gap", F.when(
        place < cut, None).when(place == cut, F.col("cut_rows")).otherwise(0).alias("used")).agg(
        F.count(F.lit(1)).alias("rows")).where("used is null or rows > used")
    taken = F.col("used").isNull()
    side = [F.when(taken, -F.col("rank")).otherwise(F.col("rank")), F.col("key")]
    standing = groups.select(
        "*", taken.alias("taken"), F.floor(F.log2(F.col("size").cast("double"))).alias("doubling"),
    ).withColumn("no", F.row_number().over(
        W.partitionBy("source_no", "taken", "doubling").orderBy(*side))).where(
        F.col("no") <= CLOSERS)

    def elected(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "rank", "key"])
        gap = float(rows["gap"].iloc[0])
        out, taken = (rows[rows["taken"] == side] for side in (False, True))
        more, less = [out.iloc[:0]], [taken.iloc[:0]]
        for _ in range(EXCHANGES):
            # the last row and column stand for nothing taken, nothing left out
            miss = np.abs(gap - (np.append(out["size"], 0)[:, None]
                                 - np.append(taken["size"], 0)[None, :]))
            add, drop = np.unravel_index(np.argmin(miss), miss.shape)
            if miss[add, drop] >= abs(gap):
                break
            more.append(out.iloc[add:add + 1])
            less.append(taken.iloc[drop:drop + 1])
            gap -= more[-1]["size"].sum() - less[-1]["size"].sum()
            out, taken = out.drop(more[-1].index), taken.drop(less[-1].index)
        more, less = pd.concat(more), pd.concat(less)
        return pd.concat([more.assign(quota=more["used"] + 1),
                          less.assign(quota=less["rows"] - 1)])[
            ["source_no", "rank", "key", "quota"]].astype({"quota": "int64"})

    # at most CLOSERS rows for each doubling of size and side
    return standing.groupBy("source_no").applyInPandas(
        elected, "source_no long, rank long, key string, quota long")


def drawn(rows: DataFrame) -> DataFrame:
    """Rows with ``copies``: certain ones and the sampled one."""
    at = cuts(rows)
    mark = ["source_no", "rank", "key"]
    ends = at.select("source_no", F.col("cut_rank").alias("rank"), F.col("cut_key").alias("key"),
                     F.col("cut_rows").alias("quota")).unionByName(closers(rows, at))
    quotas = settled(ends.groupBy(*mark).agg(F.max("quota").alias("quota")))
    before = F.coalesce(F.struct("rank", "key") < F.struct(
        F.col("cut_rank").alias("rank"), F.col("cut_key").alias("key")), F.lit(True))
    marked = settled(rows.join(at, "source_no", "left").withColumn(
        "early", F.col("rank").isNotNull() & before).drop(*at.columns[1:])
        .join(quotas, mark, "left"))
    # a quota may be for some rows of one doc_id and text: the first of them are taken
    counted = numbered(marked.where("quota is not null"), mark, ["part", "place"], ["part"],
                       "number").withColumn("more", F.col("number") < F.col("quota"))
    plain = marked.where("quota is null").withColumn("more", F.col("early"))
    return plain.unionByName(counted.drop("number")).withColumn(
        "copies", F.col("whole") + F.when(F.col("more"), 1).otherwise(0))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, expected,
    copies, taken, and key (of doc_id and text)."""
    rows = sized(docs)
    return drawn(ranked(rows, targets(rows, weights))).select(
        "doc_id", "source", "size", "source_size", "target", "expected", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "key")


def written(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The mix itself: every copy of every document as a row with all columns.

    Rows of one doc_id and text count as copies of the first of them.
    """
    totals = chosen.groupBy(F.col("key").alias("mix_key")).agg(
        F.sum("copies").alias("mix_copies"), F.count(F.lit(1)).alias("mix_rows"))
    keyed = docs.withColumn("mix_key", identity(docs)).join(
        totals.where("mix_copies > 0"), "mix_key")
    single = keyed.where("mix_rows = 1").unionByName(
        keyed.where("mix_rows > 1").dropDuplicates(["mix_key"]))
    return single.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast(
        "int")))).select(*docs.columns)


@query("op11_source_mixing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "expected")
