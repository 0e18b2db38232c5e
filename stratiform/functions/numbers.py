"""Numbers from text, and exact decimal ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratiform.functions.text import nullify_spaces


def digits_to_long(c: Column) -> Column:
    """Text made of digits only becomes a long, anything else NULL."""
    text = nullify_spaces(c)
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("long"))


def numeric_text(c: Column) -> Column:
    """Keep digits, dots and minus signs."""
    return F.nullif(F.regexp_replace(c, "[^0-9.-]", ""), F.lit(""))


def clean_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Amount text to a decimal; text that is still no number gives NULL."""
    return numeric_text(c).try_cast(f"decimal({precision},{scale})")


def clean_int(c: Column) -> Column:
    """Count text to an int, only if it is a whole number."""
    number = numeric_text(c).try_cast("decimal(20,4)")
    return F.when(number == F.floor(number), number.try_cast("int"))


def exact_ratio(num: Column, den: Column, digits: int, den_type: str = "decimal(20,0)") -> Column:
    """num / den rounded half away from zero, in decimals; NULL when den is 0 or either is NULL.

    The numerator keeps 14 decimals and 24 digits before them; the quotient is formed to more than ``digits`` decimals or,
    where the denominator is long, to six.
    """
    wide = num.cast("decimal(38,14)")
    return F.round(wide / F.nullif(den.cast(den_type), F.lit(0).cast(den_type)), digits).cast(f"decimal(28,{digits})")


def exact_mean(c: Column, digits: int) -> Column:
    """Mean of the non-NULL values of a decimal column, as an aggregate."""
    return exact_ratio(F.sum(c), F.count(c), digits)


def percent_change(now: Column, base: Column) -> Column:
    """(now - base) / base in percent, 2 digits; NULL when base is NULL or 0."""
    return exact_ratio((now - base) * F.lit(100), base, 2, "decimal(22,2)")
