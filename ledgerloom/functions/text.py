"""Text standardisation and tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Company suffixes, as whole words; S.A. with or without its dots.
COMPANY_SUFFIXES = r"LLC|INC|CORP|CO|LTD|GMBH|S\.?A\.?"

# Java's \w and \b are ASCII or JDK-dependent, so the word class is written out. One letter beyond the basic plane
# makes Java look behind by whole characters instead of half surrogate pairs.
WORD = r"\p{L}\p{N}_"
WORD_BEHIND = WORD + "\U00010400"
WORD_EDGE = rf"(?:(?<=[{WORD_BEHIND}])(?![{WORD}])|(?<![{WORD_BEHIND}])(?=[{WORD}]))"
SUFFIX_PATTERN = f"{WORD_EDGE}(?:{COMPANY_SUFFIXES}){WORD_EDGE}"
EMAIL_PATTERN = rf"^[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.]+\z"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (Spark's `trim` removes only the space)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Nothing but white space, or NULL."""
    return F.coalesce(strip(text), F.lit("")) == ""


def normalize_name(name: Column) -> Column:
    """Upper case, company suffixes removed, then only A-Z and 0-9 kept.

    A name without a Latin letter or digit becomes '' and so equals every other such name.
    """
    bare = F.regexp_replace(F.upper(name), SUFFIX_PATTERN, "")
    return F.regexp_replace(bare, "[^A-Z0-9]", "")


def is_email(text: Column) -> Column:
    """One @ with a dotted domain; letters and digits of any script."""
    return text.rlike(EMAIL_PATTERN)


def account_code(number: Column, prefix: str = "VEND-", digits: int = 5) -> Column:
    """`VEND-00042`: padded to `digits`, and longer when the number is."""
    return F.format_string(f"{prefix}%0{digits}d", number)


def line_key(document: Column, line: Column) -> Column:
    """`document-line`, a NULL part counting as ''."""
    return F.concat(
        F.coalesce(document.cast("string"), F.lit("")),
        F.lit("-"),
        F.coalesce(line.cast("string"), F.lit("")),
    )
