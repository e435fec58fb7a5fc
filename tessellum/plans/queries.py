"""All queries of the core and their SQL."""

from __future__ import annotations

from . import corpus, document, general, outline, trees

PARTS = (general, document, outline, corpus, trees)


def queries() -> dict[str, object]:
    return {k: q for p in PARTS for k, q in p.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for p in PARTS for k, q in p.oracle_sql().items()}
