"""Delimited lists: explode them, and merge articles that were cut off their names.

The work on one list stays in its row, on an array: no shuffle and no window. Arrays are unfolded by the outer form of
``explode`` and NULL items dropped after it: for the inner form Spark puts a copy of the whole array expression in a filter
below, where each look at a neighbour would build the array again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.names import NameTable, standardise_by_table
from stratiform.functions.text import ARTICLES, NAME_RULES, standardise_name


def explode_list(df: DataFrame, column: str, sep: str = ",", item: str = "item", pos: str = "pos") -> DataFrame:
    """One row per non-blank list item, trimmed, with its position from 1 in the list as written."""
    pieces = F.split(F.col(column), f"\\Q{sep}\\E")
    rows = df.select(*df.columns, F.posexplode_outer(pieces).alias("_at", "_piece"))
    return rows.select(*df.columns, (F.col("_at") + 1).alias(pos), F.trim("_piece").alias(item)).filter(
        F.col(item) != ""
    )


def tokens(c: Column, sep: str = ",") -> Column:
    """List text to an array of its trimmed, non-blank items."""
    return F.filter(F.transform(F.split(c, f"\\Q{sep}\\E"), lambda x: F.trim(x)), lambda x: x != "")


def merge_articles(
    df: DataFrame, column: str, sep: str = ",", articles: Sequence[str] = ARTICLES, into: str = "items"
) -> DataFrame:
    """Add an array of the list's items where an article is joined to the item after it, which then goes."""
    split = df.withColumn("_items", tokens(F.col(column), sep))
    items = F.col("_items")

    def merged(x: Column, i: Column) -> Column:
        after = F.get(items, i + 1)
        return F.when(
            ~F.coalesce(F.get(items, i - 1).isin(*articles), F.lit(False)),
            F.when(x.isin(*articles) & after.isNotNull(), F.concat(x, F.lit(" "), after)).otherwise(x),
        )

    joined = F.filter(F.transform(items, merged), lambda x: x.isNotNull())
    return split.withColumn(into, joined).drop("_items")


def explode_names(
    df: DataFrame, items: str, name: str, rules: Sequence[tuple[str, str]] | NameTable = NAME_RULES, first_flag: str | None = None
) -> DataFrame:
    """One row per array item under its standard name. Patterns grow the plan with each; for many rules give a ``NameTable``.

    ``first_flag`` marks one row per distinct name of the list. Its sum counts distinct parent rows per name, which saves
    the shuffle of a distinct count where the parent key is unique.
    """
    if isinstance(rules, NameTable):
        standard = standardise_by_table(F.col(items), rules, lists=True)
    else:
        standard = F.transform(F.col(items), lambda x: standardise_name(x, rules))
    rest = [c for c in df.columns if c != items]
    if first_flag is None:
        return df.select(*rest, F.explode_outer(standard).alias(name)).filter(F.col(name).isNotNull())
    # Sorted, equal names are neighbours, so one look back tells the first.
    ordered = df.withColumn("_names", F.sort_array(standard))
    pairs = F.transform(
        F.col("_names"),
        lambda x, i: F.struct(x.alias("n"), (~x.eqNullSafe(F.get(F.col("_names"), i - 1))).alias("f")),
    )
    return (
        ordered.select(*rest, F.explode_outer(pairs).alias("_pair"))
        .filter(F.col("_pair.n").isNotNull())
        .select(*rest, F.col("_pair.n").alias(name), F.col("_pair.f").alias(first_flag))
    )
