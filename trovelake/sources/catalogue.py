"""The catalogue: one DataFrame per kind of entity."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.functions import levels, paths
from trovelake.plans.settle import settled
from trovelake.sources.changes import folded, in_steps, merged

OBJECT, COLLECTION = "D", "C"

SCHEMAS = {
    "collections": "coll_id bigint, coll_path string, parent_path string, created timestamp, "
                   "modified timestamp, zone string",
    "replicas": "data_id bigint, coll_id bigint, coll_path string, data_name string, "
                "repl_num int, size bigint, checksum string, status string, resc_hier string, "
                "created timestamp, modified timestamp, zone string",
    "avus": "subject_type string, subject_id bigint, attribute string, value string, "
            "units string, modified timestamp, zone string",
    "acls": "subject_type string, subject_id bigint, owner string, owner_zone string, "
            "level string, zone string",
    "resources": "name string, location string, type string, zone string",
    "contents": "data_id bigint, coll_path string, data_name string, content binary, "
                "checksum string, zone string",
    "named_queries": "alias string, sqlStr string",
}


@dataclass(frozen=True)
class Catalogue:
    """Catalogue tables; a change gives a new Catalogue.

    ``log`` holds all changes since the tables in ``base`` were read, one row per
    key; a table is its base with the log merged in, so neither plans nor stored
    changes grow with the number of changes of a key. ``replaced`` names tables
    that were exchanged as a whole. ``in_buckets`` holds tables that are stored in
    buckets of their subject, for joins on it.
    """

    collections: DataFrame
    replicas: DataFrame
    avus: DataFrame
    acls: DataFrame
    resources: DataFrame
    contents: DataFrame
    named_queries: DataFrame
    base: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    log: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    replaced: frozenset[str] = frozenset()
    in_buckets: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, spark: SparkSession, **tables: DataFrame) -> Catalogue:
        """A catalogue of the given tables; tables not given are empty."""
        empty = {
            name: spark.createDataFrame([], schema)
            for name, schema in SCHEMAS.items() if name not in tables
        }
        return cls(**tables, **empty)

    def with_tables(self, **tables: DataFrame) -> Catalogue:
        """Other tables in place of those given, which lose their log."""
        return replace(
            self, **tables, replaced=self.replaced | set(tables),
            base={n: t for n, t in self.base.items() if n not in tables},
            log={n: c for n, c in self.log.items() if n not in tables},
            in_buckets={n: t for n, t in self.in_buckets.items() if n not in tables})

    def changed(self, **changes: DataFrame) -> Catalogue:
        """The catalogue after changes (see ``sources.changes``) that hold each
        key once. They are stored, so each is computed once."""
        base, log, tables = dict(self.base), dict(self.log), {}
        in_buckets = dict(self.in_buckets)
        for name, rows in changes.items():
            base.setdefault(name, getattr(self, name))
            rows = rows.select(*[
                F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)
                .alias(f.name) for f in getattr(self, name).schema], "op")
            if name in log:
                rows = folded(name, in_steps(log[name], settled(rows)))
            log[name] = settled(rows)
            tables[name] = merged(name, base[name], log[name])
            if name in in_buckets:
                base.setdefault(f"{name} in buckets", in_buckets[name])
                in_buckets[name] = merged(name, base[f"{name} in buckets"], log[name])
        return replace(self, **tables, base=base, log=log, in_buckets=in_buckets)

    def of_subjects(self, name: str) -> DataFrame:
        """A table for a join on its subject."""
        return self.in_buckets.get(name, getattr(self, name))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}

    def union(self, other: Catalogue) -> Catalogue:
        """Federation of two catalogues, each holding its own zones."""
        return Catalogue(**{
            name: table.unionByName(getattr(other, name), allowMissingColumns=True)
            for name, table in self.tables().items()
        })

    @property
    def spark(self) -> SparkSession:
        return self.replicas.sparkSession

    # -- derived relations ---------------------------------------------------

    def objects(self) -> DataFrame:
        """Data objects: replicas without their replica columns."""
        return self.replicas.select("data_id", "coll_path", "data_name", "zone").distinct()

    def paths(self) -> DataFrame:
        """Every path with its kind and id, for existence checks."""
        objects = self.objects().select(
            F.lit(OBJECT).alias("subject_type"), F.col("data_id").alias("subject_id"),
            paths.to_path(F.col("coll_path"), F.col("data_name")).alias("path"),
            "coll_path", "data_name", "zone",
        )
        collections = self.collections.select(
            F.lit(COLLECTION).alias("subject_type"), F.col("coll_id").alias("subject_id"),
            F.col("coll_path").alias("path"), "coll_path",
            F.lit(None).cast("string").alias("data_name"), "zone",
        )
        return objects.unionByName(collections)

    def good_replicas(self) -> DataFrame:
        return self.replicas.where(F.col("status") == "1")


def access_rows(acls: DataFrame, namespace: Column | None = None) -> DataFrame:
    """Load ACL rows: access tokens only, in user words."""
    if namespace is not None:
        acls = acls.where(namespace == "access_type")
    return acls.withColumn("level", levels.level_word(F.col("level")))
