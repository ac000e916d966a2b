"""All queries of this subpackage, with the SQL of those that have one."""

from trovelake.llm import (  # noqa: F401  (each module fills QUERIES)
    bpe_trie, embedding_whitening, katz_backoff, kd_search, line_chunks, quality_gam,
    shingle_join, source_mixing, template_decontamination, token_alignment, token_records,
    url_templates, warc_derivatives,
)
from trovelake.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
