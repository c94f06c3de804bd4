"""Cleaning rules for scraped text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.fixed import NULL_TOKENS

NBSP = "\u00a0"
# Java's \s leaves out the no-break space, which scraped pages are full of.
WHITE = " \t\n\r\x0b\x0c" + NBSP
_RUN = r"[\s\u00A0]+"
_CODE = r"[A-Z]{3}$"
_CODE_AFTER_NAME = r"(?<=[^\s\u00A0])[\s\u00A0]*[A-Z]{3}$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    """Text without white space (no-break spaces included) at both ends."""
    return F.btrim(c, F.lit(WHITE))


def plain_spaces(c: Column) -> Column:
    """No-break spaces become spaces, then the ends are trimmed."""
    return F.trim(F.translate(c, NBSP, " "))


def normal(c: Column) -> Column:
    """Lower-case text with every run of white space as one space."""
    return F.lower(F.trim(F.regexp_replace(c, _RUN, " ")))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def without_stars(c: Column) -> Column:
    """Footnote text without its asterisks."""
    return F.trim(F.replace(c, F.lit("*"), F.lit("")))


def label(prefix: str, c: Column) -> Column:
    """``prefix`` and a number as one label, such as ``Practice 2``."""
    return F.concat_ws(" ", F.lit(prefix), c.cast("string"))


def known_text(c: Column, *more_tokens: str) -> Column:
    """Text, or null where it only says that there is no value."""
    return F.when(~normal(c).isin(*NULL_TOKENS, *more_tokens), c)


def first_number(c: Column) -> Column:
    """The first signed number in a text; a comma counts as the decimal point."""
    found = F.regexp_extract(F.translate(c, ",", "."), r"[-+]?\d+(?:\.\d+)?", 0)
    return found.try_cast("double")


def number(c: Column, to: str = "double") -> Column:
    """Text as a number of type ``to``; null when it is not a number (or not a whole one)."""
    text = strip(c.cast("string"))
    # words are out before the cast: a failed cast costs far more than the test; -0 becomes 0
    value = F.when(text.rlike(_NUMBER), text).try_cast("double") + F.lit(0.0)
    if to in ("double", "float"):
        return value.cast(to)
    return F.when(value == F.rint(value), value.try_cast(to))


def mentions(c: Column, phrase: str) -> Column:
    """Whether the text holds a phrase, whatever its case."""
    return F.contains(F.lower(c), F.lit(phrase.lower()))


def is_gap(c: Column) -> Column:
    return F.startswith(strip(c), F.lit("+"))


def gap_part(c: Column) -> Column:
    """A combined time-or-gap cell as a gap, null when it holds a time."""
    return F.when(is_gap(c), c)


def time_part(c: Column) -> Column:
    """A combined time-or-gap cell as a time, null when it holds a gap."""
    return F.when(~is_gap(c), c)


def driver_code(driver: Column) -> Column:
    """The three capitals at the end of a driver cell, null when there are none."""
    return null_if_blank(F.regexp_extract(strip(driver), _CODE, 0))


def driver_name(driver: Column) -> Column:
    """A driver cell without its trailing code; a cell that is only a code stays whole."""
    return F.regexp_replace(strip(driver), _CODE_AFTER_NAME, "")
