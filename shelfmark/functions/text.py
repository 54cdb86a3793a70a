"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character the Unicode database calls white space
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# fixed values: decorative characters removed once at each end of a quotation
OPENING_QUOTES = '"«'
CLOSING_QUOTES = '"»'

UNKNOWN_AUTHOR = "Unknown"
DEFAULT_CATEGORY = "Uncategorized"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Trim every Unicode white-space character (``trim`` alone only knows U+0020)."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def slug(col: Column) -> Column:
    return F.replace(F.lower(col), F.lit(" "), F.lit("-"))


def title_case(col: Column) -> Column:
    """Capitalise every run of letters: ``SAINT-denis l'île`` -> ``Saint-Denis L'Île``."""
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(
        runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
    )
    return F.array_join(cased, "")


def strip_quotes(
    col: Column, opening: str = OPENING_QUOTES, closing: str = CLOSING_QUOTES
) -> Column:
    """Strip, drop at most one decorative character at each end, strip again."""

    def unquoted(text: Column) -> Column:
        begins = reduce(or_, [text.startswith(c) for c in opening])
        ends = reduce(or_, [text.endswith(c) for c in closing])
        # a lone quote character counts once, as an opening one
        first = F.when(begins, 2).otherwise(1)
        dropped = F.when(begins, 1).otherwise(0) + F.when(ends, 1).otherwise(0)
        return F.substr(text, first, F.greatest(F.length(text) - dropped, F.lit(0)))

    return strip(let(strip(col), unquoted))


def excerpt(col: Column, length: int = 80, ellipsis: str = "...") -> Column:
    return F.concat(F.left(col, F.lit(length)), F.lit(ellipsis))


def normalise_tags(tags: Column) -> Column:
    """Lower-case and strip each tag; a missing list becomes an empty one."""
    return F.transform(
        F.coalesce(tags, F.array().cast("array<string>")), lambda t: strip(F.lower(t))
    )


def text_hash(col: Column) -> Column:
    """MD5 of the stripped, lower-cased text: the identity of a quotation."""
    return F.md5(F.lower(strip(col)).cast("binary"))


def stable_key(*cols: Column) -> Column:
    """60-bit integer key taken from the MD5 of the natural key."""
    natural = cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)
    return F.conv(F.left(F.md5(natural.cast("binary")), F.lit(15)), 16, 10).cast("bigint")
