"""Access levels: the user's word and the catalogue's token."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# User word -> catalogue token.
LEVEL_TOKENS = {
    "null": "null",
    "own": "own",
    "read": "read object",
    "write": "modify object",
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(entries, F.lower(key))


def level_token(word: Column) -> Column:
    """Token of a user word in any case; NULL for an unknown word."""
    return _lookup(LEVEL_TOKENS, word)


def level_word(token: Column) -> Column:
    """User word of a token; anything unknown passes through."""
    return F.coalesce(_lookup({v: k for k, v in LEVEL_TOKENS.items()}, token), token)


def is_level(word: Column) -> Column:
    return F.coalesce(F.lower(word).isin(*LEVEL_TOKENS), F.lit(False))
