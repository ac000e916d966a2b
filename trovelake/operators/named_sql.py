"""Named, parameterised SQL over the catalogue tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.functions.errors import GENERAL, RequestError, error, first_error
from trovelake.sources.catalogue import Catalogue

# Aliases and labels. Named queries that come with every catalogue; '?' are string arguments.
BUILT_IN = {
    "findQueryByAlias": "SELECT alias, sqlStr FROM named_queries WHERE alias = ?",
    "dataModifiedIdOnly":
        "SELECT DISTINCT data_id FROM replicas "
        "WHERE modified >= timestamp_seconds(CAST(? AS BIGINT) + 1) "
        "AND modified < timestamp_seconds(CAST(? AS BIGINT) + 1)",
    "dataModifiedPartial":
        "SELECT c.coll_path AS coll_name, r.data_name, r.data_id, r.repl_num AS data_repl_num, "
        "r.checksum AS data_checksum, unix_seconds(r.modified) AS data_modify_ts, "
        "r.status AS data_repl_status "
        "FROM replicas r JOIN collections c ON r.coll_id = c.coll_id "
        "WHERE r.modified >= timestamp_seconds(CAST(? AS BIGINT) + 1) "
        "AND r.modified < timestamp_seconds(CAST(? AS BIGINT) + 1)",
    "metadataModifiedIdOnly":
        "SELECT DISTINCT r.data_id FROM replicas r JOIN metamap m ON r.data_id = m.object_id "
        "WHERE m.modified >= timestamp_seconds(CAST(? AS BIGINT) + 1) "
        "AND m.modified < timestamp_seconds(CAST(? AS BIGINT) + 1)",
    "metadataModifiedPartial":
        "SELECT c.coll_path AS coll_name, o.data_name, o.data_id, t.meta_id, "
        "t.attribute AS meta_attr_name, t.value AS meta_attr_value, t.units AS meta_attr_unit, "
        "unix_seconds(m.modified) AS meta_modify_ts "
        "FROM replicas o JOIN collections c ON o.coll_id = c.coll_id "
        "JOIN metamap m ON o.data_id = m.object_id JOIN metadata t ON m.meta_id = t.meta_id "
        "WHERE m.modified >= timestamp_seconds(CAST(? AS BIGINT) + 1) "
        "AND m.modified < timestamp_seconds(CAST(? AS BIGINT) + 1)",
    "showCollAcls":
        "SELECT a.owner, a.owner_zone AS zone, a.level FROM acls a "
        "JOIN collections c ON a.subject_id = c.coll_id "
        "WHERE a.subject_type = 'C' AND c.coll_path = ?",
}


def meta_id() -> Column:
    """Id of an attribute/value/units triple: equal triples are one."""
    return F.md5(F.concat_ws("|", "attribute", "value", F.coalesce("units", F.lit(""))))


def register_views(catalogue: Catalogue) -> None:
    """Catalogue tables as temporary views, with metadata split as a server
    keeps it: ``metadata`` (one row per triple) and ``metamap`` (its uses)."""
    spark = catalogue.spark
    named = spark.createDataFrame(list(BUILT_IN.items()), "alias string, sqlStr string")
    own = catalogue.named_queries.join(named, "alias", "left_anti").select("alias", "sqlStr")
    for name, table in catalogue.tables().items():
        table.createOrReplaceTempView(name)
    named.unionByName(own).createOrReplaceTempView("named_queries")
    avus = catalogue.avus.withColumn("meta_id", meta_id())
    avus.select("meta_id", "attribute", "value", "units").distinct().createOrReplaceTempView(
        "metadata")
    avus.where("subject_type = 'D'").select(
        F.col("subject_id").alias("object_id"), "meta_id", "modified"
    ).createOrReplaceTempView("metamap")


def sql_of(catalogue: Catalogue, text: str, free: bool = False) -> str:
    """The SQL behind an alias, or a registered SQL text itself; an alias must
    be unique. Other text is only run with ``free``: a statement has the rights
    of the session, so authors of requests may not send their own."""
    if text in BUILT_IN:
        return BUILT_IN[text]
    if text.lstrip().lower().startswith("select"):
        known = catalogue.named_queries.where(F.col("sqlStr") == text)
        if free or text in BUILT_IN.values() or not known.isEmpty():
            return text
        raise RequestError("this statement is not registered", GENERAL)
    rows = catalogue.named_queries.where(F.col("alias") == text).select("sqlStr").take(2)
    if len(rows) != 1:
        raise RequestError(
            f"'{text}' stands for {'several statements' if rows else 'no statement'}", GENERAL)
    return rows[0].sqlStr


def checked_args(sql: str, args: list[str]) -> list[str]:
    """The arguments, if there is one for each '?' outside of quotes and those
    that are cast to whole numbers are such."""
    marks = _marks(sql)
    if len(marks) != len(args):
        raise RequestError(f"the query takes {len(marks)} arguments, not {len(args)}", GENERAL)
    for number, (at, arg) in enumerate(zip(marks, args), 1):
        if _takes_number(sql, at) and not re.fullmatch(r"\s*[+-]?[0-9]{1,12}\s*", arg):
            raise RequestError(f"argument {number} is no whole number", GENERAL)
    return args


def run(catalogue: Catalogue, text: str, args: list[str] | None = None,
        free: bool = True) -> DataFrame:
    """Run SQL, or the SQL of an alias, with string arguments for its '?'.

    Labels are the columns of the result. See ``sql_of`` for ``free``.
    """
    register_views(catalogue)
    sql = sql_of(catalogue, text, free)
    return catalogue.spark.sql(sql, args=checked_args(sql, list(args or [])))


# -- many requests at once ----------------------------------------------------------

ARGUMENTS = "given_arguments"


def statements(catalogue: Catalogue) -> DataFrame:
    """(text, statement, n): what a request may name, an alias or a registered
    statement itself, with the number of statements it stands for."""
    own = catalogue.named_queries.where(~F.col("alias").isin(*BUILT_IN)).select(
        "alias", "sqlStr")
    known = catalogue.spark.createDataFrame(
        list(BUILT_IN.items()), "alias string, sqlStr string").unionByName(own)
    texts = known.select("sqlStr").unionByName(catalogue.named_queries.select("sqlStr"))
    by_text = texts.select(F.col("sqlStr").alias("text"), F.col("sqlStr").alias("statement"))
    by_alias = known.select(F.col("alias").alias("text"), F.col("sqlStr").alias("statement"))
    return by_text.distinct().unionByName(by_alias).groupBy("text").agg(
        F.max("statement").alias("statement"), F.count(F.lit(1)).alias("n"))


def _marks(sql: str) -> list[int]:
    """Places of the '?' outside of quotes."""
    places = re.sub(r"'[^']*'", lambda m: " " * len(m.group()), sql)
    return [m.start() for m in re.finditer(r"\?", places)]


def _takes_number(sql: str, at: int) -> bool:
    """Is the argument at this place cast to a whole number?"""
    return bool(re.search(r"CAST\(\s*$", sql[:at], re.IGNORECASE) and re.match(
        r"\?\s+AS\s+(BIGINT|INT)", sql[at:], re.IGNORECASE))


def resolved(catalogue: Catalogue, asked: DataFrame) -> DataFrame:
    """Requests (text, args, error) with ``statement``, or the error of those
    whose statement is not known, or not given its arguments."""
    known = statements(catalogue)
    # the registered statements, not the requests
    texts = [r.statement for r in known.where("n = 1").select("statement").distinct().collect()]
    takes = F.create_map(*[F.lit(x) for t in texts for x in (t, len(_marks(t)))])
    numbers = F.create_map(*[x for t in texts for x in (F.lit(t), F.array(
        *[F.lit(_takes_number(t, at)) for at in _marks(t)]).cast("array<boolean>"))])
    rows = asked.join(known, "text", "left")
    wanted = F.try_element_at(takes, F.col("statement"))
    is_number = F.try_element_at(numbers, F.col("statement"))
    bad = F.exists(F.arrays_zip(is_number.alias("number"), F.col("args").alias("arg")), lambda z: (
        z["number"] & ~F.rlike(z["arg"], F.lit(r"^\s*[+-]?[0-9]{1,12}\s*$"))))
    selects = F.startswith(F.lower(F.ltrim("text")), F.lit("select"))
    return rows.withColumn("error", F.coalesce("error", first_error(
        (F.col("n").isNull() & selects, error("this statement is not registered", GENERAL)),
        (F.col("n").isNull(), error(F.format_string(
            "nothing is registered under '%s'", "text"), GENERAL)),
        (F.col("n") > 1, error(F.format_string(
            "'%s' stands for several statements", "text"), GENERAL)),
        (wanted != F.size("args"), error(F.format_string(
            "the query takes %d arguments, not %d", wanted, F.size("args")), GENERAL)),
        (bad, error("an argument is no whole number", GENERAL))))).drop("n")


def answered(catalogue: Catalogue, statement: str, arguments: DataFrame) -> DataFrame:
    """Rows of a statement for each list of arguments, with the list in the column
    ``ARGUMENTS``: the statement is a lateral query, its '?' columns of a table."""
    register_views(catalogue)
    parts, start = [], 0
    for number, at in enumerate(_marks(statement)):
        parts += [statement[start:at], f"asked_arguments.{ARGUMENTS}[{number}]"]
        start = at + 1
    query = "".join([*parts, statement[start:]])
    arguments.select(F.col("args").alias(ARGUMENTS)).createOrReplaceTempView("asked_arguments")
    return catalogue.spark.sql(
        f"SELECT asked_arguments.{ARGUMENTS}, answers.* "
        f"FROM asked_arguments, LATERAL ({query}) AS answers")


# -- named changes of one replica -----------------------------------------------------

def _set_on_replicas(replicas: DataFrame, named: DataFrame, column: str,
                     value: str) -> DataFrame:
    """Set one column of the replicas named by (coll_path, data_name, repl_num)."""
    keys = ["coll_path", "data_name", "repl_num"]
    hit = named.select(*keys).distinct().withColumn("hit", F.lit(True))
    rows = replicas.join(hit, keys, "left")
    return rows.withColumn(column, F.when(F.col("hit"), value).otherwise(
        F.col(column))).select(*replicas.columns)


def set_stale(replicas: DataFrame, named: DataFrame) -> DataFrame:
    return _set_on_replicas(replicas, named, "status", doc.STALE)


def set_checksum_invalid(replicas: DataFrame, named: DataFrame) -> DataFrame:
    return _set_on_replicas(replicas, named, "checksum", "0")
