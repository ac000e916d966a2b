"""Registered queries, each with the SQL that checks it where SQL can."""

from trovelake.registry.book import BOOK

from trovelake.registry import (  # noqa: F401  (each module fills BOOK)
    access_queries, batch_queries, content_queries, function_queries, join_queries,
    listing_queries, metadata_queries, named_queries, search_queries, source_queries,
    stream_queries, tree_queries,
)

__all__ = ["BOOK"]
