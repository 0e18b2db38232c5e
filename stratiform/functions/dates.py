"""Dates from mixed text, and calendar keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratiform.functions.text import nullify, nullify_spaces

# Fixed values: (shape, format) tried in order; a shape that matches decides the format.
ROUTES = (
    (r"\A\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"\A\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
    (r"\A\d{1,2}-\d{1,2}-\d{4}\z", "d-M-yyyy"),
)
# Formats for free mixed text, the last one day-first for what month-first cannot read.
MIXED_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "d/M/yyyy")


def parse_routed_date(c: Column, routes: Sequence[tuple[str, str]] = ROUTES) -> Column:
    """Route text to one date format by its shape; other shapes and impossible dates give NULL."""
    text = nullify_spaces(c)
    out = F.lit(None).cast("date")
    for shape, fmt in reversed(list(routes)):
        out = F.when(text.rlike(shape), F.try_to_date(text, fmt)).otherwise(out)
    return out


def normalise_mixed_date(c: Column, formats: Sequence[str] = MIXED_FORMATS) -> Column:
    """Mixed date text to yyyy-MM-dd text, the first readable format wins; row-local, so the order of rows is no matter."""
    text = nullify(c)
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats]).cast("string")


def date_key(c: Column) -> Column:
    """A date as the int yyyymmdd."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def wall_clock(c: Column, zone: str = "+08:00") -> Column:
    """ISO text to wall-clock time in a zone; text without an offset is taken as it is."""
    has_offset = c.rlike(r"(Z|[+-]\d{2}:?\d{2})\z")
    # The zone's clock as an instant in UTC, and from there by microseconds: the session zone's own clock repeats an hour each autumn.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    shifted = F.timestamp_add("MICROSECOND", F.unix_micros(F.from_utc_timestamp(F.try_to_timestamp(c), zone)), epoch)
    return F.when(has_offset, shifted).otherwise(c.try_cast("timestamp_ntz"))


def in_years(c: Column, first: int, last: int) -> Column:
    """Whether a date or time lies in a range of years, as bounds on the column itself, which reach the file scan."""
    low, high = (F.lit(dt.datetime(y, 1, 1).isoformat(sep=" ")).cast("timestamp_ntz") for y in (first, last + 1))
    return (c >= low) & (c < high)
