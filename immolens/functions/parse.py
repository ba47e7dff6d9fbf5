"""Text -> typed value expressions (Column -> Column, all JVM-side).

Every parse of free text goes through ``try_*`` so a bad value becomes null
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extraction patterns, default city and URL rule of the contract.
PRICE_PATTERN = r"(\d+)\s*€"
SURFACE_PATTERN = r"(\d+)\s*m²"
ROOMS_PATTERN = r"(\d+)\s*pièce"
CITY_PATTERN = r"([A-ZÉÈÎÔÂÛÙÇ][a-zéèîôâûùç\- ]+)\s*\(76\)"
DEFAULT_CITY = "Rouen"
URL_PATTERN = r"^https?://"
DATE_FORMATS = ["yyyy-MM-dd", "dd-MM-yyyy"]

# French-style numbers: digit groups split by a space, NBSP or narrow NBSP,
# optional decimal comma. Only the integer part is kept.
_FR_NUMBER = r"(\d{1,3}(?:[ \x{a0}\x{202f}]\d{3})+|\d+)(?:,\d+)?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_int(c: Column | str, pattern: str) -> Column:
    """First capture group of ``pattern`` as int; no match, null or overflow -> null."""
    return F.regexp_extract(_col(c), pattern, 1).try_cast("int")


def fr_unit_pattern(unit_regex: str) -> str:
    """Pattern for a French-formatted number followed by a unit."""
    return _FR_NUMBER + r"\s*" + unit_regex


def extract_fr_int(c: Column | str, unit_regex: str) -> Column:
    """Like ``extract_int`` but reads ``1 250`` as 1250 and ``45,5`` as 45."""
    raw = F.regexp_extract(_col(c), fr_unit_pattern(unit_regex), 1)
    return F.regexp_replace(raw, r"[^0-9]", "").try_cast("int")


def extract_city(c: Column | str, pattern: str = CITY_PATTERN,
                 default: str = DEFAULT_CITY) -> Column:
    """Name captured before the department code, trimmed; else ``default``."""
    found = F.trim(F.regexp_extract(_col(c), pattern, 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def listing_id(url: Column | str) -> Column:
    """Last path segment of the URL after dropping one trailing slash."""
    return F.substring_index(F.regexp_replace(_col(url), r"/$", ""), "/", -1)


def is_http_url(url: Column | str) -> Column:
    """True for http(s) URLs, null for null."""
    return _col(url).rlike(URL_PATTERN)


def tolerant_date(c: Column | str, formats: list[str] | None = None) -> Column:
    """H2: first format that parses wins; nothing parses -> null."""
    s = _col(c)
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt in (formats or DATE_FORMATS)])


def epoch_day_to_date(c: Column | str) -> Column:
    """V5: day count since 1970-01-01 -> date."""
    return F.date_from_unix_date(_col(c).cast("int"))


def round2(c: Column | str) -> Column:
    """ROUND(x, 2): one rounding, half away from zero."""
    return F.round(_col(c).cast("double"), 2)


def amount_parts(c: Column | str) -> dict[str, Column]:
    """Aggregates that add up an amount and can be added up again: ``cents``
    (whole cents, as a long), ``rest`` (null, or the sum of the amounts that are
    no whole number of cents or too large for one) and ``n`` (non-null rows)."""
    x = _col(c).cast("double")
    cents = F.rint(x * 100)
    whole = (cents / 100 == x) & (F.abs(cents) <= F.lit(float(1 << 53)))
    return {"cents": F.sum(F.when(whole, cents.cast("long"))), "rest": F.sum(F.when(~whole, x)), "n": F.count(x)}


def mean_of_parts(cents: Column, rest: Column, n: Column) -> Column:
    """ROUND(sum / n, 2) of added-up parts (``cents`` a long or decimal)."""
    total = F.coalesce(cents.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    rows = n.cast("decimal(20,0)")
    rounded = F.call_function("div", F.abs(total) * 2 + rows, rows * 2)           # half a cent goes up
    exact = F.signum(total) * rounded / F.lit(100.0)
    return F.when(n > 0, F.when(rest.isNull(), exact)
                  .otherwise(F.round((total.cast("double") / 100 + rest) / n, 2)))


def mean2(c: Column | str) -> Column:
    """ROUND(AVG(x), 2) of an amount, as an aggregate.

    Whole cents are added up as longs, so their sum is exact and the same
    whatever the order in which partitions arrive; a mean that lies half way
    between two cents is then rounded away from zero on every run. Amounts with
    a finer fraction, or of more than 2^53 cents, are added up as doubles (as
    a plain average does). The mean is rounded once."""
    return mean_of_parts(**amount_parts(c))


def price_per_m2(price: Column | str, surface: Column | str) -> Column:
    """round2(price / surface) when surface > 0, else null (true division)."""
    p, s = _col(price).cast("double"), _col(surface).cast("double")
    return F.when(p.isNotNull() & (s > 0), round2(p / s))


def whole_price_per_m2(price: Column | str, surface: Column | str) -> Column:
    """``price_per_m2`` of whole numbers (int columns): the same values, by
    integer division instead of decimal text, which takes a part of the time."""
    p, s = _col(price).cast("long"), _col(surface).cast("long")
    cents = F.call_function("div", F.abs(p) * 200 + s, s * 2)                     # half a cent goes away from zero
    return F.when(p.isNotNull() & (s > 0), F.when(p < 0, -cents).otherwise(cents) / F.lit(100.0))
