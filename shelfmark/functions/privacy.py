"""Pseudonyms, bands and validity tests for personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import WHITESPACE, blank_to_null, strip

# fixed values: revenue bands as (upper bound, label), lowest first
REVENUE_BANDS = (
    (100_000, "< 100k€"),
    (250_000, "100k€ - 250k€"),
    (500_000, "250k€ - 500k€"),
    (1_000_000, "500k€ - 1M€"),
)
REVENUE_TOP_BAND = "> 1M€"
REVENUE_UNKNOWN = "Non renseigné"

# fixed values: accepted formats
EMAIL_RE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_RE = r"^(0[1-9][0-9]{8}|[1-9][0-9]{8})$"
POSTCODE_RE = r"^[0-9]{5}$"


def pseudonym(col: Column, salt: str) -> Column:
    """Salted SHA-256 of the stripped value; NULL and empty stay NULL."""
    salted = F.concat(F.lit(salt + ":"), strip(col))
    return F.when(col.isNotNull() & (col != ""), F.sha2(salted.cast("binary"), 256))


def contact_pseudonym(name: Column, email: Column, phone: Column, salt: str) -> Column:
    """One pseudonym for the non-empty parts of a contact."""
    parts = [blank_to_null(strip(c)) for c in (name, email, phone)]
    return pseudonym(blank_to_null(F.concat_ws("|", *parts)), salt)


def md5_hex(col: Column) -> Column:
    return F.md5(col.cast("string").cast("binary"))


def initials(name: Column) -> Column:
    """First character of each white-space separated word."""
    words = F.split(F.translate(strip(name), WHITESPACE, " " * len(WHITESPACE)), " +")
    return F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")


def revenue_band(
    col: Column,
    bands: Sequence[tuple[float, str]] = REVENUE_BANDS,
    top: str = REVENUE_TOP_BAND,
    unknown: str = REVENUE_UNKNOWN,
) -> Column:
    out = F.when(col.isNull(), F.lit(unknown))
    for bound, label in bands:
        out = out.when(col < F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(top))


def _given(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def valid_postcode(col: Column) -> Column:
    return F.coalesce(strip(col).rlike(POSTCODE_RE), F.lit(False))


def valid_email(col: Column) -> Column:
    return ~_given(col) | strip(col).rlike(EMAIL_RE)


def valid_phone(col: Column) -> Column:
    """Ten digits with a leading zero, or nine where the zero was lost."""
    bare = F.translate(col, WHITESPACE + ".-", "")
    return ~_given(col) | bare.rlike(PHONE_RE)


def present(col: Column) -> Column:
    return F.coalesce(_given(col), F.lit(False))
