"""All queries of this subpackage, by name."""

from __future__ import annotations

from pricelode.llm import queries

QUERIES = {**queries.QUERIES}
SQL = {**queries.SQL}
