"""Text cleaning expressions (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.split()`` treats as
# whitespace (ASCII blanks, \x0b, \x1c-\x1f, \x85 and the Unicode
# separators). Written so the class means the same in Java regex and RE2.
WHITESPACE_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"

# Square-metre spellings normalised to "m²", in this order.
SQUARE_METRE_SPELLINGS = ["m 2", "m2"]
SQUARE_METRE = "m²"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: Column | str) -> Column:
    """Runs of any whitespace -> one space, then trimmed."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_CLASS + "+", " "))


def clean_text(c: Column | str) -> Column:
    """Empty -> null; CR/LF -> space; m2 -> m²; whitespace collapsed.

    A string of blanks only stays an empty string (it is not empty before
    cleaning), as the original Python cleaning did.
    """
    s = _col(c)
    out = F.replace(F.replace(s, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    for spelling in SQUARE_METRE_SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(SQUARE_METRE))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(
        collapse_whitespace(out))


def collapse_newlines(c: Column | str) -> Column:
    """Each run of CR/LF becomes a single space."""
    return F.regexp_replace(_col(c), r"[\r\n]+", " ")


def capitalize_first(c: Column | str) -> Column:
    """V2: upper-case the first character, lower-case the rest.

    Not ``initcap``, which capitalises every word.
    """
    s = _col(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2147483647)))
