"""Multi-term search predicates (F2, F4, F5, F11, F12) as Columns.

Server-side search follows SQLite LIKE: ASCII-only case folding, ``%`` and
``_`` in the user's term stay wildcards, no escape character. We fold A-Z on
both sides with ``translate`` and use a case-sensitive ``like``; ``\\`` in the
term is doubled because Spark's LIKE treats it as the escape character.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()

# Fixed values (API keys and their order): project search fields; "po" is the PO/vendor
# existence test (F4) and is resolved by the caller.
PROJECT_SEARCH_FIELDS = {
    "project_id": "project_id",
    "store": "store",
    "city": "city",
    "contractor": "general_contractor",
    "scope": "scope",
    "sap_def": "proj_def",
    "banner": "banner",
    "status": "project_status",
    "po": None,
}

# Fixed values (API keys): PO search fields (F5) over the joined PO base.
PO_SEARCH_FIELDS = {
    "po_number": "po_number",
    "vendor": "vendor",
    "store": "store",
    "store_sequence": "store_sequence",
    "city": "city",
    "state": "state",
    "sap_def": "proj_def",
    "status": "project_status",
    "project_id": "project_id",
    "project_type": "project_type",
    "scope": "scope",
    "contractor": "general_contractor",
    "banner": "banner",
}

# Haystack fields of the static bundle (F11 projects, F12 POs).
STATIC_PROJECT_HAYSTACK = ("store", "city", "state", "scope", "general_contractor", "project_id",
                           "store_sequence", "project_type")
STATIC_PO_HAYSTACK = ("po_number", "vendor", "store", "project_status", "po_status", "scope",
                      "general_contractor", "project_type")


def split_terms(search: str | None) -> list[str]:
    """';'-separated terms, trimmed, empties dropped (blank => no terms)."""
    if not search:
        return []
    return [t.strip() for t in search.split(";") if t.strip()]


def ascii_fold(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def fold_text(s: str) -> str:
    return s.translate(str.maketrans(_UPPER, _LOWER))


def like_contains(c: Column, term: str) -> Column:
    """SQLite ``c LIKE '%term%'`` (NULL stays NULL, as in three-valued SQL)."""
    pattern = "%" + fold_text(term).replace("\\", "\\\\") + "%"
    return ascii_fold(c).like(pattern)


def parse_project_fields(fields: tuple[str, ...] | list[str] | None) -> list[str]:
    """Valid keys in the given order; empty or all-invalid means all."""
    keys = [k for k in (fields or []) if k in PROJECT_SEARCH_FIELDS]
    return keys or list(PROJECT_SEARCH_FIELDS)


def project_search(search: str | None, fields, po_match: Callable[[str], Column] | None) -> Column | None:
    """AND across terms of OR across active fields; None means no filter.

    ``po_match(term)`` returns the Column that is true when some PO of the
    row's project matches the term (F4); it is built by the caller from a
    semi join so the PO table is never collected.
    """
    terms = split_terms(search)
    if not terms:
        return None
    active = parse_project_fields(fields)
    clauses = []
    for term in terms:
        parts = []
        for key in active:
            col = PROJECT_SEARCH_FIELDS[key]
            if col is None:
                if po_match is not None:
                    parts.append(po_match(term))
            else:
                parts.append(like_contains(F.col(col), term))
        clauses.append(reduce(lambda a, b: a | b, parts))
    return reduce(lambda a, b: a & b, clauses)


def po_search(search: str | None, fields) -> Column | None:
    """like F2, but unknown keys are skipped and none valid => no filter."""
    terms = split_terms(search)
    if not terms:
        return None
    active = list(fields) if fields else list(PO_SEARCH_FIELDS)
    active = [k for k in active if k in PO_SEARCH_FIELDS]
    if not active:
        return None
    clauses = [reduce(lambda a, b: a | b, [like_contains(F.col(PO_SEARCH_FIELDS[k]), t) for k in active])
               for t in terms]
    return reduce(lambda a, b: a & b, clauses)


def haystack(fields: tuple[str, ...]) -> Column:
    """F11/F12 haystack: lower-cased fields joined by one space, NULL as ''."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]))


def haystack_search(search: str | None, fields: tuple[str, ...]) -> Column | None:
    """Every (lower-cased) term must be a plain substring of the haystack."""
    terms = split_terms((search or "").lower())
    if not terms:
        return None
    hay = haystack(fields)
    return reduce(lambda a, b: a & b, [F.contains(hay, F.lit(t)) for t in terms])
