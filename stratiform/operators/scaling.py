"""Whole-column statistics put next to every row.

The statistics are a scalar subquery: one row by construction, computed in its own pruned pass and read as a constant, so
there is no join at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from stratiform.functions.numbers import exact_ratio


def with_scalar(df: DataFrame, source: DataFrame, aggregate, name: str) -> DataFrame:
    """Attach one aggregate of ``source`` to all rows of ``df``."""
    return df.select(*df.columns, source.agg(aggregate.alias(name)).scalar().alias(name))


def statistics(df: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    """df, of which the next action also takes the statistics of a column; ``known_statistics`` reads them then, so that writing a
    column and scaling what was written need one pass over it. Spark counts each partition of the action once, also when lost
    executors make it repeat tasks."""
    seen = Observation()
    return df.observe(seen, *[e.alias(n) for n, e in {**_range(column), **_spread(column)}.items()]), seen


def known_statistics(df: DataFrame, column: str, seen: Observation) -> Column:
    """What was observed, as a constant to scale the same column of df with."""
    kind = df.schema[column].dataType
    kinds = {"lo": kind, "hi": kind, "mean": T.DoubleType(), "dev": T.DoubleType()}
    return F.struct(*[F.lit(seen.get[n]).cast(t).alias(n) for n, t in kinds.items()])


def _with_stats(df: DataFrame, column: str, stats: dict) -> DataFrame:
    packed = F.struct(*[e.alias(n) for n, e in stats.items()])
    return with_scalar(df, df.select(column), packed, "_stats")


def _minmax(column: str, digits: int) -> Column:
    lo, hi = F.col("_stats.lo"), F.col("_stats.hi")
    return exact_ratio(F.col(column) - lo, hi - lo, digits, "decimal(28,13)")


def _zscore(column: str, digits: int) -> Column:
    distance = F.col(column).cast("double") - F.col("_stats.mean")
    return F.round(distance / F.nullif(F.col("_stats.dev"), F.lit(0.0)), digits).cast(f"decimal({6 + digits},{digits})")


def _range(column: str) -> dict[str, Column]:
    return {"lo": F.min(column), "hi": F.max(column)}


def _spread(column: str) -> dict[str, Column]:
    value = F.col(column).cast("double")
    return {"mean": F.avg(value), "dev": F.stddev_samp(value)}


def minmax(df: DataFrame, column: str, out: str, digits: int = 6) -> DataFrame:
    """Min-max normalise; NULL when all values are equal."""
    return _with_stats(df, column, _range(column)).withColumn(out, _minmax(column, digits)).drop("_stats")


def zscore(df: DataFrame, column: str, out: str, digits: int = 6) -> DataFrame:
    """Distance to the mean in sample standard deviations; NULL when the deviation is 0 or unknown."""
    return _with_stats(df, column, _spread(column)).withColumn(out, _zscore(column, digits)).drop("_stats")


def minmax_and_zscore(
    df: DataFrame, column: str, minmax_out: str, zscore_out: str, digits: int = 6, known: Column | None = None
) -> DataFrame:
    """Both, from one pass for the statistics, or from known ones."""
    if known is None:
        rows = _with_stats(df, column, {**_range(column), **_spread(column)})
    else:
        rows = df.withColumn("_stats", known)
    return rows.withColumns({minmax_out: _minmax(column, digits), zscore_out: _zscore(column, digits)}).drop("_stats")
