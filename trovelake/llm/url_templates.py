"""URL filter: rules first, then a tree of path templates per host.

Every host has a tree of its path segments. Going down level by level, a node
with many different children becomes a wildcard (``*``), so that
``/en/825`` and ``/en/676`` meet in ``/en/*``. Leaves are templates. URLs that a
rule decides are the labelled examples. Sibling branches, templates that differ
in their first fixed segment only, whose share of blocked examples is
statistically the same, are merged and pool their examples. A branch without
examples is merged with its siblings of like structure; where these have none
either, the nearest node above it that has some stands for it. A template whose
smoothed share of blocked examples reaches the threshold is rejected.

What makes a node a wildcard is how many different children it has, not how
often each occurs, so a tree does not change as the rows of a host multiply.

Only DataFrame functions are used. A hot host is combined before each shuffle;
its rows meet the (small) node tables in joins that Spark can split.

* A null URL, or one without ``://``, has an empty host and path; it belongs to
  no rule and is allowed by the template of the empty host.
* Repeated rows count as often as they occur and are all returned.
* Segments below ``LEVELS`` count as one segment, so paths of any depth take
  part whole.
* Extra columns are carried along, also with names that are used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.llm.common import ascii_lower, query, table
from trovelake.plans.settle import settled

LEVELS = 4           # levels of the tree
WILD_CHILDREN = 8    # a node with at least so many different children is a wildcard
SMOOTHING = 4.0      # examples that the prior counts as
THRESHOLD = 0.8      # smoothed share of blocked examples that rejects
LEAST_EXAMPLES = 3   # a template with fewer examples is not rejected
SIMILAR_Z = 1.96     # branches within so many deviations of the pool are merged

# (verdict, host, path); the longest that fits decides.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null without one."""
    decided = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        decided = F.when(fits, F.struct(F.lit(name + start).alias("rule"),
                                        F.lit(verdict).alias("verdict"))).otherwise(decided)
    return decided


def templates(urls: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Add ``template`` to rows with ``host`` and ``segments``."""
    rows = urls.withColumn("template", F.lit(""))
    for level in range(levels):
        last = level == levels - 1
        segment = (F.array_join(F.slice("segments", level + 1, 1_000_000_000), "/") if last
                   else F.get("segments", F.lit(level)))
        there = F.size("segments") > level
        rows = rows.withColumn("segment", F.when(there, segment))
        children = rows.where(there).select("host", "template", "segment").distinct()
        wild = (
            children.groupBy("host", "template")
            .agg(F.count(F.lit(1)).alias("children"))
            .where(F.col("children") >= WILD_CHILDREN)
            .select("host", "template", F.lit(True).alias("wild"))
        )
        name = F.when(F.col("wild"), F.lit("*")).otherwise(F.col("segment"))
        rows = rows.join(wild, ["host", "template"], "left").withColumn(
            "template", F.when(F.col("segment").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), name))).drop("wild", "segment")
    return rows


def merged_purity(leaves: DataFrame) -> DataFrame:
    """Merge similar branches; add the smoothed share of blocked examples.

    ``leaves``: (host, template, labelled, blocked), a row per template. Siblings
    are templates that differ in their first fixed segment only.
    """
    branch = F.regexp_replace("template", r"^/[^/*]+", "/+")
    pools = leaves.withColumn("branch", branch).where("labelled > 0")
    pool = pools.groupBy("host", "branch").agg(
        F.sum("labelled").alias("pool_labelled"), F.sum("blocked").alias("pool_blocked"))
    share = F.col("pool_blocked") / F.col("pool_labelled")
    deviation = F.sqrt(F.col("labelled") * share * (1 - share))
    similar = F.col("pool_labelled").isNotNull() & (
        F.abs(F.col("blocked") - F.col("labelled") * share) <= SIMILAR_Z * deviation)
    above, ancestor = with_examples_above(leaves), F.col("ancestor")
    marked = leaves.withColumn("branch", branch).join(pool, ["host", "branch"], "left").join(
        above, ["host", "template"], "left").withColumn(
        "node", F.when(similar, F.col("branch"))
        .when(ancestor.isNotNull(), F.concat(ancestor, F.lit("/**")))
        .otherwise(F.col("template")))
    # labelled leaves pool their examples; where none is in a branch, its siblings do
    nodes = marked.groupBy("host", "node").agg(
        F.sum("labelled").alias("own"), F.sum("blocked").alias("own_bad"),
        F.max(F.when(similar, F.struct("pool_labelled", "pool_blocked")).otherwise(F.struct(
            F.col("above_labelled").alias("pool_labelled"),
            F.col("above_blocked").alias("pool_blocked")))).alias("lent"))
    lent = F.col("own") == 0
    nodes = nodes.select(
        "host", "node",
        F.when(lent, F.coalesce("lent.pool_labelled", F.lit(0))).otherwise(F.col("own")).alias("examples"),
        F.when(lent, F.coalesce("lent.pool_blocked", F.lit(0))).otherwise(F.col("own_bad")).alias("bad"))
    prior = leaves.agg((F.coalesce(F.sum("blocked"), F.lit(0))
                        / F.greatest(F.sum("labelled"), F.lit(1))).alias("prior")).scalar()
    purity = (F.col("bad") + SMOOTHING * prior) / (F.col("examples") + SMOOTHING)
    scored = nodes.withColumn("blocked_share", purity)
    return marked.select("host", "template", "node").join(scored, ["host", "node"]).select(
        "host", "template", "node", "examples", "blocked_share",
        ((F.col("examples") >= LEAST_EXAMPLES) & (F.col("blocked_share") >= THRESHOLD))
        .alias("rejected"))


def with_examples_above(leaves: DataFrame) -> DataFrame:
    """(host, template, ancestor, above_labelled, above_blocked): for templates
    without examples the deepest node above that has some."""
    parts = F.split("template", "/")
    # a template has at most LEVELS + 1 nodes above it, the root is ""
    above = leaves.withColumn("ancestor", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(LEVELS))),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))
    known = above.groupBy("host", "ancestor").agg(
        F.sum("labelled").alias("above_labelled"), F.sum("blocked").alias("above_blocked")
    ).where("above_labelled > 0")
    deepest = F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor",
                             "above_labelled", "above_blocked")).alias("best")
    return above.where("labelled = 0").select("host", "template", "ancestor").join(
        known, ["host", "ancestor"]).groupBy("host", "template").agg(deepest).select(
        "host", "template", "best.ancestor", "best.above_labelled", "best.above_blocked")


def filtered(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Judge the ``url`` of every page.

    Returns page_id, host, path, rule, verdict, template (the node that the
    method judged by), examples and blocked_share.
    """
    urls = pages.select("page_id", F.col("url"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("ruled", ruled(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.col("ruled.verdict").alias("decided"),
        F.filter(F.split("path", "/"), lambda s: s != "").alias("segments"))
    leaves = settled(templates(urls).drop("segments"))
    labelled = F.count("decided")
    counted = leaves.groupBy("host", "template").agg(
        labelled.alias("labelled"),
        F.count(F.when(F.col("decided") == "block", 1)).alias("blocked"))
    judged = merged_purity(counted)
    return leaves.join(judged, ["host", "template"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", F.when(F.col("rejected"), "block").otherwise("allow"))
        .alias("verdict"),
        F.col("node").alias("template"), "examples", "blocked_share")


@query("op10_url_templates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "pages"))
