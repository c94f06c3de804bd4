"""Times: text to seconds and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.text import strip

# up to three parts of plain digits, with optional signs and a decimal fraction in the last one
_CLOCK = r"^([+-]?\d+:){0,2}[+-]?(\d+\.?\d*|\.\d+)$"


def seconds(c: Column) -> Column:
    """``[[H:]M:]S[.fff]`` with an optional leading ``+`` and trailing ``s`` as seconds, else null."""
    body = F.rtrim(F.ltrim(F.lower(strip(c)), F.lit("+")), F.lit("s"))
    # words are out before anything is cast: a failed cast costs far more than the test
    parts = F.split(F.when(body.rlike(_CLOCK), body), ":")

    def part(from_end: int) -> Column:
        return F.try_element_at(parts, F.lit(-from_end)).try_cast("double")

    return F.coalesce(part(3), F.lit(0.0)) * 3600 + F.coalesce(part(2), F.lit(0.0)) * 60 + part(1)


def clock(secs: Column) -> Column:
    """Seconds as ``HH:MM:SS``, rounded to whole seconds before they are split."""
    whole = F.round(secs).cast("long")
    return F.when(
        secs.isNotNull(),
        F.format_string("%02d:%02d:%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60),
    )


def to_millis(secs: Column) -> Column:
    """Seconds rounded to three decimals."""
    return F.round(secs, 3)


def millis_or_zero(secs: Column) -> Column:
    """Seconds rounded to three decimals, 0 for a missing time."""
    return F.coalesce(to_millis(secs), F.lit(0.0))


def from_leader(base: Column, gap: Column, strict: bool = False) -> Column:
    """Leader's time plus gap.

    A row without gap gets the leader's time; with ``strict`` it stays null instead.
    """
    return to_millis(base + (gap if strict else F.coalesce(gap, F.lit(0.0))))
