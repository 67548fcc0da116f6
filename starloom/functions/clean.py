"""Column cleaning expressions (X2-X7). All JVM-side, ANSI-safe (``try_*``).

Spark 4 runs with ``spark.sql.ansi.enabled=true``: a plain ``cast('' as int)``
or ``to_date('', fmt)`` fails the whole job. Every parser here turns a bad
value into NULL instead, which is what the pre-ANSI source pipeline relied on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed source formats of the app feed (values that must match the source).
RELEASE_DATE_FORMAT = "MMM d, yyyy"
SCRAPE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TRUE_TEXT = "True"

# Shortest text each feed format can parse. Spark's try_to_date and
# try_to_timestamp build and swallow an exception for every value that does
# not parse (~6 us/row, 20x a successful parse), so empty and short values are
# turned away by a length test first -- a necessary condition of a successful
# parse, so results are unchanged. (A regex shape test costs ~1 us/row on the
# valid values, which are the common case.)
FORMAT_MIN_LENGTH = {
    RELEASE_DATE_FORMAT: len("Jan 5, 2020"),
    SCRAPE_TIME_FORMAT: len("2021-06-15 20:19:35"),
}
INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_quotes(col: Column | str) -> Column:
    """Remove ``"`` from both ends; inner doubled quotes stay doubled.

    ``btrim`` with characters walks the whole text, so a text without a quote at
    either end, as most fields are, is turned away by its first and last byte.
    """
    c = _c(col).cast("string")
    return F.when(c.startswith('"') | c.endswith('"'), F.btrim(c, F.lit('"'))).otherwise(c)


def unescape_quotes(col: Column | str) -> Column:
    """Optional: turn CSV-escaped ``""`` into ``"``."""
    return F.replace(_c(col), F.lit('""'), F.lit('"'))


def clean_flag(col: Column | str, true_text: str = TRUE_TEXT) -> Column:
    """Exactly ``True`` -> 'Y', anything else (NULL, '', 'true') -> 'N'."""
    return F.when(_c(col) == F.lit(true_text), F.lit("Y")).otherwise(F.lit("N"))


def clean_long(col: Column | str) -> Column:
    """Integer text, also ``'10000.0'``, to bigint; bad values -> NULL.

    Goes through a decimal with 28 digits before the point, so all digits of a
    bigint stay, and drops the fraction. (``try_cast('10000.0' as bigint)`` is
    NULL, at the price of an exception per value; double loses digits beyond
    2^53 and is left for texts that no such decimal holds.)
    """
    c = _c(col)
    number = c.try_cast("decimal(38,10)")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("bigint")
    return F.coalesce(whole, c.try_cast("double").try_cast("bigint"))


def clean_int_parity(col: Column | str) -> Column:
    """X5 as the source computed it: int, NULL beyond 2^31-1.

    The range test avoids an overflow exception per out-of-range value.
    """
    d = _c(col).try_cast("double")
    return F.when(d.between(F.lit(INT_MIN), F.lit(INT_MAX)), d.try_cast("int"))


def clean_double(col: Column | str) -> Column:
    """Rating / price text to double; bad values -> NULL."""
    return _c(col).try_cast("double")


def clean_size(col: Column | str, parity: bool = False) -> Column:
    """Size text such as ``15M``, ``900k``, ``1.2G`` to megabytes.

    Unit aware by default (k/1024, M, G*1024); anything else, e.g.
    ``Varies with device``, is NULL. ``parity=True`` reproduces the source
    rule: drop the last character and cast to float (so ``900k`` -> 900).
    """
    c = _c(col)
    body = c.substr(F.lit(1), F.length(c) - F.lit(1))
    if parity:
        return body.try_cast("float")
    unit = F.substring(c, -1, 1)
    value = body.try_cast("double")
    return (F.when(unit.isin("k", "K"), value / F.lit(1024.0))
            .when(unit.isin("M", "m"), value)
            .when(unit.isin("G", "g"), value * F.lit(1024.0)))


def _parsable(c: Column, fmt: str) -> Column:
    return F.length(F.trim(c)) >= F.lit(FORMAT_MIN_LENGTH.get(fmt, 1))


def clean_date(col: Column | str, fmt: str = RELEASE_DATE_FORMAT) -> Column:
    """``Jan 5, 2020`` -> date; empty or malformed -> NULL."""
    c = _c(col)
    return F.when(_parsable(c, fmt), F.try_to_date(c, fmt))


def clean_timestamp(col: Column | str, fmt: str = SCRAPE_TIME_FORMAT, ntz: bool = True) -> Column:
    """``2021-06-15 20:19:35`` -> timestamp; bad -> NULL.

    ``ntz`` keeps the wall-clock value without a time zone (the warehouse
    column is a zone-less timestamp); parsing uses the session time zone.
    """
    c = _c(col)
    ts = F.when(_parsable(c, fmt), F.try_to_timestamp(c, F.lit(fmt)))
    return ts.cast("timestamp_ntz") if ntz else ts
