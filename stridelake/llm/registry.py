"""Queries and oracle SQL of the thirteen operators and of the pipeline."""

from __future__ import annotations

import corpus_pipeline
from stridelake.llm import byte_bpe, chain_dedup, filter_audit, html_extraction, jaccard_join, language_id, media_columns, merkle_manifest, personal_data, quality_rules, sequence_packing, suffix_dedup, url_filters

_MODULES = (suffix_dedup, quality_rules, jaccard_join, language_id, chain_dedup, media_columns, personal_data, html_extraction, sequence_packing, byte_bpe, merkle_manifest, url_filters, filter_audit)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
