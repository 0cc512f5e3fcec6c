"""Named queries over the test tables, each with an equivalent DuckDB statement where SQL can say it."""

from __future__ import annotations

from larder.catalog import images, keys, landing, merging, quality, retrieval, scanning, text

MODULES = (text, keys, landing, merging, quality, images, retrieval, scanning)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
