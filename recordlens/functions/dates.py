"""Date text parsing that yields null instead of raising (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens.functions.text import as_col, strip_ws


_TIME = r"(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?(?: ?(?:Z|[+-][0-9]{2}:[0-9]{2}))?"
_ISO_DATE_TIME = rf"^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})(?:[ T]{_TIME})?$"
_ISO_START = r"^[0-9]{4}(?:-[0-9]{1,2}(?:-[0-9]{1,2})?)?$"

#: Date forms beside ISO by their shape: month names in any case, and no text is parsed that cannot be of its form.
DATE_FORMS = (
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} [0-9]{1,2}, [0-9]{4}$", "MMMM d, yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{4,} [0-9]{4}$", "d MMMM yyyy"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
)


def iso_date(c: str | Column) -> Column:
    """Date of an ISO date, alone or followed by a valid time; null for anything else."""
    return F.try_to_date(F.nullif(F.regexp_extract(as_col(c), _ISO_DATE_TIME, 1), F.lit("")), "yyyy-MM-dd")


def year_of(c: str | Column) -> Column:
    return F.year(iso_date(c)).cast("int")


def date_text(c: str | Column) -> Column:
    """The date part of a date-like text: whitespace stripped, a valid time after it cut."""
    text = strip_ws(as_col(c))
    # Only a text that ends in a time has a colon.
    return F.when(F.contains(text, F.lit(":")), F.regexp_replace(text, rf"[ T]{_TIME}$", "")).otherwise(text)


def parse_date_text(text: str | Column) -> Column:
    """Date of a text without a time, null when it does not parse.

    ISO dates ('yyyy', 'yyyy-[m]m', 'yyyy-[m]m-[d]d') go through the cheap
    cast, any other text through the one form of ``DATE_FORMS`` that has its shape.
    """
    text = as_col(text)
    parsed = F.when(text.rlike(_ISO_START), text.try_cast("date"))
    for shape, form in DATE_FORMS:
        parsed = parsed.when(text.rlike(shape), F.try_to_date(F.initcap(text) if "MMM" in form else text, form))
    return parsed


def parse_date_lenient(c: str | Column) -> Column:
    """Date of a date-like text, null when it does not parse; any text but a valid time after the date makes it null.

    Where many rows are parsed, give ``date_text`` a column of its own first, so that it is computed once.
    """
    return parse_date_text(date_text(c))
