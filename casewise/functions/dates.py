"""Dates of differing precision.

A format code says how much of the date is known. A month resolves to its first
day, and the precision travels in a column of its own. Malformed text gives null
under ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewise.schema import DATE_FULL, DATE_MONTH


def _is_full(value: Column, fmt: Column) -> Column:
    return (fmt == DATE_FULL) | (fmt.isNull() & (F.length(value) == 8))


def _day(text: Column) -> Column:
    # Eight digits as an ISO text: the plain cast is much faster than a pattern parser
    # and knows no time zone. The guard keeps it from accepting other spellings.
    parts = (F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike("^[0-9]{8}$"), F.concat_ws("-", *parts).try_cast("date"))


def parse_partial_date(value: Column, fmt: Column) -> Column:
    """Date of a partial date text, or null when no day can be derived."""
    return F.when(_is_full(value, fmt), _day(value)).when(
        fmt == DATE_MONTH, _day(F.concat(value, F.lit("01")))
    )


def date_precision(value: Column, fmt: Column) -> Column:
    """``day``, ``month`` or ``unknown``; always ``unknown`` when the date is null."""
    day_or_month = F.when(_is_full(value, fmt), F.lit("day")).otherwise(F.lit("month"))
    return F.when(parse_partial_date(value, fmt).isNotNull(), day_or_month).otherwise(
        F.lit("unknown")
    )


def compact_date(value: Column) -> Column:
    """A date as ``YYYYMMDD``."""
    return F.date_format(value, "yyyyMMdd")
