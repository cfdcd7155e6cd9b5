"""All queries of the subpackage and their SQL."""

from __future__ import annotations

from cairnfield.llm import queries_groups, queries_names, queries_places, queries_text

MODULES = (queries_groups, queries_names, queries_places, queries_text)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
