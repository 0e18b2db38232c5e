"""Text cleaning: trimming, missing values, list delimiters and name rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Cell texts that a landed delimited file treats as missing.
FILE_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Lower-cased texts that count as blank when duplicates are collapsed.
PLACEHOLDERS = ("", "none", "null", "nan")
# Every character that counts as white space at the ends of a cell.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE) + "]"
_NOT_SPACE = "[^" + _SPACE[1:]
# Words that belong to the list token after them.
ARTICLES = ("The", "A", "An")
# Fixed values: (pattern, standard name), first match wins.
NAME_RULES = ((r"(?i)^lions\s*gate", "Lions Gate Films"),)
# A bar with any white space around it.
BAR = r"\s*\|\s*"


def strip(c: Column) -> Column:
    """Trim all white space, not only spaces."""
    return F.trim(c, F.lit(WHITE_SPACE))


def nullify(c: Column) -> Column:
    """Strip; empty becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def nullify_file_cell(c: Column, missing: Sequence[str] = FILE_MISSING) -> Column:
    """A cell as landed: missing markers and blanks become NULL, the rest is stripped."""
    return F.when(~c.isin(*missing), nullify(c))


def nullify_spaces(c: Column) -> Column:
    """Trim spaces only; empty becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """NULL, empty or only white space."""
    return ~F.coalesce(c.cast("string").rlike(_NOT_SPACE), F.lit(False))


def is_placeholder(c: Column, words: Sequence[str] = PLACEHOLDERS) -> Column:
    """Blank, or one of some words in any case with white space around."""
    any_word = "|".join(re.escape(w) for w in words if w)
    return F.coalesce(c.cast("string").rlike(rf"(?i)\A{_SPACE}*(?:{any_word})?{_SPACE}*\z"), F.lit(True))


def rewrite_delimiters(c: Column, pattern: str = BAR, to: str = ",") -> Column:
    return F.nullif(F.regexp_replace(F.trim(c), pattern, to), F.lit(""))


def standardise_name(c: Column, rules: Sequence[tuple[str, str]] = NAME_RULES) -> Column:
    out = c
    for pattern, name in reversed(list(rules)):
        out = F.when(c.rlike(pattern), F.lit(name)).otherwise(out)
    return out
