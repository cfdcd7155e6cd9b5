"""All queries of the core and their SQL."""

from __future__ import annotations

from cairnfield.plans import curation, domain, relational, workflow

FLAGSHIP = "accounts_by_revenue"
MODULES = (relational, curation, workflow, domain)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
