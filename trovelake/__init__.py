"""Catalogue-metadata analytics on Spark.

A catalogue (collections, data-object replicas, metadata, permissions,
resources, content) is a set of DataFrames; requests against it are DataFrames
too, and every operation answers all of its requests with one Spark plan.
"""

from trovelake.sources.catalogue import Catalogue
from trovelake.session import tune

__all__ = ["Catalogue", "tune"]
