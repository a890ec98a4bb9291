"""Scalar cleaning expressions.

Raw report text is cast with ``try_*`` functions behind explicit guards: ANSI mode
is on by default in Spark 4, and a single malformed cell must turn into NULL, not
fail a job that covers every symbol at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide which text counts as a number (optional sign, digits
# with an optional fraction, optional exponent, surrounding blanks allowed).
# Spark's own cast accepts more, e.g. '1d' -> 1.0, which the source data treats
# as junk; the guard rejects it before the cast.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Regular expressions applied to listing and dividend text.
MARKET_CAP_UNIT_DROP = r"[$0-9.]"     # what is left is the unit letter (M, B or '')
MARKET_CAP_NUMBER_DROP = r"[$MB]"     # what is left is the number (no scaling)
AMOUNT_DROP = r"(/\s/g)?([A-Z]?)"     # removes capital letters from Amount
CURRENCY_PREFIX = r"([A-Z]*)"         # first (possibly empty) run of capitals
DOLLAR = r"\$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text (or number) to double; anything that is not a plain number -> NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def volume_number(c) -> Column:
    """'1,234' -> 1234.0; '???', '1d', '' -> NULL."""
    return to_number(F.regexp_replace(_col(c).cast("string"), ",", ""))


def round_half_even(c, digits: int = 2) -> Column:
    """Round the scaled double half-to-even (``rint(x * 10^d) / 10^d``).

    Spark's ``round``/``bround`` work on the decimal value and give 1.02 for
    1.015; the binary double 1.015 * 100 is 101.4999..., which must give 1.01.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def parse_us_date(c) -> Column:
    """'m/d/yyyy' with one- or two-digit month and day -> date; invalid -> NULL."""
    return F.try_to_date(_col(c).cast("string"), "M/d/yyyy")


def parse_iso_or_us_date(c) -> Column:
    s = _col(c).cast("string")
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "M/d/yyyy"))


def iso_date(c) -> Column:
    """Date -> 'yyyy-MM-dd' text (how stored dates are shown)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def strip_whitespace(c) -> Column:
    return F.regexp_replace(_col(c), r"\s+", "")


def leading_capitals(c) -> Column:
    """Currency code: the first run of capitals at the start ('' when none)."""
    return F.regexp_extract(_col(c), CURRENCY_PREFIX, 1)


def strip_amount(c) -> Column:
    """Amount text without capital letters and without '$' (stays text)."""
    return F.regexp_replace(F.regexp_replace(_col(c), AMOUNT_DROP, ""), DOLLAR, "")


def underscore_name(name: str) -> str:
    """Column-name rule: every space becomes an underscore."""
    return name.replace(" ", "_")
