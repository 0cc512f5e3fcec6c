"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from larder.llm import (
    class_model, decontaminate, fill_middle, language_id, license_scan, line_dedup, mixing, ngram_join, packing, periodic_runs, quality_rules,
    sharding, substring_dedup,
)

MODULES = (
    ngram_join, substring_dedup, decontaminate, class_model, language_id, line_dedup, license_scan, mixing, quality_rules, sharding,
    fill_middle, periodic_runs, packing,
)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
