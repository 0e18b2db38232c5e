"""Gap-filling from a second source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from stratiform.functions.text import is_blank


def attach(df: DataFrame, source: DataFrame, key: str, columns: Sequence[str], suffix: str = "_src") -> DataFrame:
    """Left join the named source columns, pruned before the join. The source must have one row per key.

    No broadcast hint: Spark picks the side by its measured size, and splits hot keys of the left side at run time.
    """
    right = source.select(key, *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    return df.join(right, key, "left")


def fill_blank(df: DataFrame, pairs: Mapping[str, str], count_as: str | None = None) -> DataFrame:
    """Fill each target that is NULL or blank from its source column where that is not NULL.

    ``count_as`` adds the number of cells filled in the row (on top of a count already there).
    """
    fills = {t: is_blank(F.col(t)) & F.col(s).isNotNull() for t, s in pairs.items()}
    new = {t: F.when(fills[t], F.col(s)).otherwise(F.col(t)) for t, s in pairs.items()}
    if count_as:
        count = F.col(count_as) if count_as in df.columns else F.lit(0)
        for fill in fills.values():
            count = count + fill.cast("int")
        new[count_as] = count
    return df.withColumns(new)


def fill_missing(
    df: DataFrame, source: DataFrame, key: str, mapping: Mapping[str, str], count_as: str | None = None
) -> DataFrame:
    """Fill blank targets from a second source on one key; ``mapping`` is target column → source column."""
    wanted = list(dict.fromkeys(mapping.values()))
    joined = attach(df, source, key, wanted)
    filled = fill_blank(joined, {t: f"{s}_src" for t, s in mapping.items()}, count_as)
    return filled.drop(*[f"{c}_src" for c in wanted])
