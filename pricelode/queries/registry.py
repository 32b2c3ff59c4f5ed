"""All queries of the core, by name."""

from __future__ import annotations

from pricelode.queries import parsing, problems, reference

QUERIES = {**problems.QUERIES, **reference.QUERIES, **parsing.QUERIES}
SQL = {**problems.SQL, **reference.SQL, **parsing.SQL}
