"""Display-name and fallback expressions of the clean model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens.functions.text import as_col


def person_name(first: str | Column, last: str | Column, fallback: str | Column) -> Column:
    """trim(first || ' ' || last); blank -> fallback id (SQL TRIM: spaces only)."""
    full = F.concat(F.coalesce(as_col(first), F.lit("")), F.lit(" "),
                    F.coalesce(as_col(last), F.lit("")))
    return F.coalesce(F.nullif(F.trim(full), F.lit("")), as_col(fallback))


def org_name(org: str | Column, fallback: str | Column) -> Column:
    """Trimmed organisation; null/blank -> fallback id."""
    return F.coalesce(F.nullif(F.trim(F.coalesce(as_col(org), F.lit(""))), F.lit("")),
                      as_col(fallback))


def grant_kind(kind: str | Column, ptype: str | Column) -> Column:
    """COALESCE(NULLIF(kind, ''), NULLIF(type, ''))."""
    return F.coalesce(F.nullif(as_col(kind), F.lit("")), F.nullif(as_col(ptype), F.lit("")))
