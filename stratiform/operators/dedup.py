"""Duplicate keys: profile them, collapse them without losing values, or keep one row.

All of it is one ``groupBy(key)`` of ``max_by``/``min_by``/``count`` aggregates. Keys repeat a few times and far apart, so rows are dealt
out by key as they came, and what picking needs is made of them after the shuffle: the states of the aggregates are several times as wide
as a row, and to combine them first every task would sort all it has read. Keys that hold a large part of the rows (``hot_keys``) are
combined before the shuffle instead, and so never meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.text import is_placeholder, strip


def _name(c: str) -> Column:
    """A column of any name, also of one that is no SQL word."""
    return F.col(f"`{c}`")


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [_name(c) if isinstance(c, str) else c for c in order]


def _latest_value(order: Sequence[str | Column]) -> Column:
    """One comparable value, never NULL itself, whose greatest is the last row; a NULL in it is less than any value."""
    return F.struct(*[c.alias(f"o{k}") for k, c in enumerate(_columns(order))])


def _first_value(order: Sequence[str | Column]) -> Column:
    """One comparable value, never NULL itself, whose least is the first row; a NULL in it is greater than any value."""
    parts = [p for c in _columns(order) for p in (c.isNull(), c)]
    return F.struct(*[p.alias(f"o{k}") for k, p in enumerate(parts)])


def hot_keys(df: DataFrame, key: str, least: int = 5_000_000) -> list:
    """Keys, NULL among them, of at least ``least`` rows: too many for one task. A job over the key column; the list has at most one key
    for each ``least`` rows."""
    counts = df.groupBy(_name(key)).agg(F.count(F.lit(1)).alias("n_rows_of_key"))
    return [r[0] for r in counts.where(F.col("n_rows_of_key") >= least).collect()]


def _grouped(df: DataFrame, key: str, hot: Sequence, group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``group`` over rows that are dealt out by key; those of hot keys are combined ahead of the shuffle."""
    if not hot:
        return group(df.repartition(_name(key)))
    is_hot = F.coalesce(_name(key).isin([k for k in hot if k is not None]), F.lit(None in hot))
    return group(df.where(~is_hot).repartition(_name(key))).unionByName(group(df.where(is_hot)))


def key_groups(
    df: DataFrame, key: str, order: Sequence[str | Column], columns: Sequence[str], signals: Sequence[str], hot: Sequence = ()
) -> DataFrame:
    """One row per key with all that profiling and collapsing need.

    ``last`` holds ``columns`` of the last row in ``order`` (which must be total; a row with a NULL there comes before those
    with a value), ``value_<c>`` the last non-blank text of a
    signal column, ``filled_<c>`` its non-blank count. Two rows differ if either of two 64-bit row hashes does, so only
    numbers, and not the texts again, are kept to find conflicts.
    """
    parts = [c.alias(f"_o{k}") for k, c in enumerate(_columns(order))]
    narrow = df.select(_name(key), *parts, *[_name(c) for c in dict.fromkeys([*columns, *signals]) if c != key])
    return _grouped(narrow, key, hot, lambda rows: _group(rows, key, [f"_o{k}" for k in range(len(parts))], columns, signals))


def _group(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], signals: Sequence[str]) -> DataFrame:
    texts = [strip(F.coalesce(_name(c).cast("string"), F.lit(""))) for c in signals]
    filled = {c: f"_filled_{c}" for c in signals}
    # Worked out once per row ahead of the aggregate, which reads each of them several times.
    rows = df.select(
        _name(key),
        _latest_value(order).alias("_seq"),
        *[_name(c) for c in dict.fromkeys([*columns, *signals]) if c != key],
        *[(~is_placeholder(_name(c))).alias(filled[c]) for c in signals],
        F.xxhash64(*texts).alias("_hash_0"),
        F.xxhash64(F.lit(key), *reversed(texts)).alias("_hash_1"),
    )
    aggs = [F.count(F.lit(1)).alias("group_rows"), F.max_by(F.struct(*[_name(c) for c in columns]), "_seq").alias("last")]
    for n in (0, 1):
        aggs += [F.min(f"_hash_{n}").alias(f"low_{n}"), F.max(f"_hash_{n}").alias(f"high_{n}")]
    for c in signals:
        aggs.append(F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{filled[c]}`"), F.col("_seq"))).alias(f"value_{c}"))
        aggs.append(F.count_if(F.col(f"`{filled[c]}`")).alias(f"filled_{c}"))
    return rows.groupBy(_name(key)).agg(*aggs)


def collapse_groups(
    groups: DataFrame, key: str, columns: Sequence[str], signals: Sequence[str], counters: bool = False
) -> DataFrame:
    """The last row per key, its blank signal cells recovered from earlier rows of the key.

    ``counters`` adds per-key counts (``COUNTERS``) that sum up to the statistics of the step, so no second pass over the
    source is needed for them.
    """
    last, value, blank_ = (lambda c: F.col(f"last.`{c}`")), (lambda c: F.col(f"`value_{c}`")), (lambda c: F.col(f"`blank_{c}`"))
    flagged = groups.select("*", *[is_placeholder(last(c)).alias(f"blank_{c}") for c in signals])
    cells = []
    for c in columns:
        if c == key:
            cells.append(_name(key))
        elif c in signals:
            cells.append(F.when(blank_(c), F.coalesce(value(c), last(c))).otherwise(last(c)).alias(c))
        else:
            cells.append(last(c).alias(c))
    if counters:
        recovered = sum(((blank_(c) & value(c).isNotNull()).cast("long") for c in signals), F.lit(0).cast("long"))
        lost = sum((F.when(blank_(c), F.col(f"`filled_{c}`")).otherwise(0) for c in signals), F.lit(0).cast("long"))
        cells += [
            F.col("group_rows").alias("n_rows"),
            F.expr("group_rows - 1").alias("n_rejected"),
            recovered.alias("n_recovered"),
            lost.alias("n_lost"),
            F.expr("low_0 <> high_0 OR low_1 <> high_1").alias("conflict"),
        ]
    return flagged.select(*cells)


COUNTERS = ("n_rows", "n_rejected", "n_recovered", "n_lost", "conflict")


def group_statistics() -> list[Column]:
    """Aggregates over the counters of :func:`collapse_groups`."""
    totals = {
        "duplicate_groups": "count_if(n_rows > 1)",
        "duplicate_rows": "coalesce(sum(if(n_rows > 1, n_rows, 0)), 0)",
        "exact_duplicate_groups": "count_if(n_rows > 1 AND NOT conflict)",
        "conflicting_duplicate_groups": "count_if(n_rows > 1 AND conflict)",
        "keys_with_potential_value_loss": "count_if(n_lost > 0)",
        "potential_value_loss_cells": "coalesce(sum(n_lost), 0)",
        "rows_rejected_dedup": "coalesce(sum(n_rejected), 0)",
        "keys_recovered_from_duplicates": "count_if(n_recovered > 0)",
        "cells_recovered_from_duplicates": "coalesce(sum(n_recovered), 0)",
    }
    return [F.expr(e).alias(n) for n, e in totals.items()]


def collapse_duplicates(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    signals: Sequence[str],
    counters: bool = False,
    columns: Sequence[str] | None = None,
    hot: Sequence = (),
) -> DataFrame:
    """One row per key; ``columns`` are those to keep, all by default. ``hot``: keys of very many rows (``hot_keys``)."""
    columns = list(columns or df.columns)
    groups = key_groups(df, key, order, [c for c in columns if c != key], signals, hot)
    return collapse_groups(groups, key, columns, signals, counters)


def dedup_profile(df: DataFrame, key: str, order: Sequence[str | Column], signals: Sequence[str], hot: Sequence = ()) -> DataFrame:
    """One row: duplicate groups and rows, exact and conflicting groups, what keep-last would lose, risk and status."""
    counted = collapse_groups(key_groups(df, key, order, signals, signals, hot), key, [key], signals, counters=True)
    lossy = F.col("keys_with_potential_value_loss") > 0
    conflicting = F.col("conflicting_duplicate_groups") > 0
    repeated = F.col("duplicate_groups") > 0
    return counted.agg(*group_statistics()).withColumns(
        {
            "risk": F.when(lossy, "HIGH").when(conflicting, "MEDIUM").when(repeated, "LOW"),
            "dedup_status": F.when(lossy, "REVIEW NEEDED")
            .when(conflicting, "CHECK CONFLICTS")
            .when(repeated, "SAFE DEDUP")
            .otherwise("NO DUPLICATES"),
        }
    )


def _one_per_key(df: DataFrame, key: str, hot: Sequence, pick) -> DataFrame:
    others = [c for c in df.columns if c != key]
    row = pick(F.struct(*[_name(c) for c in others])).alias("row")
    cells = [_name(c) if c == key else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    return _grouped(df, key, hot, lambda rows: rows.groupBy(_name(key)).agg(row).select(*cells))


def keep_first(df: DataFrame, key: str, order: Sequence[str | Column], hot: Sequence = ()) -> DataFrame:
    """The least row per key in ``order``, NULLs last."""
    return _one_per_key(df, key, hot, lambda row: F.min_by(row, _first_value(order)))


def latest_per_key(df: DataFrame, key: str, order: Sequence[str | Column], hot: Sequence = ()) -> DataFrame:
    """The greatest row per key in ``order``, NULLs last; rows without a key are dropped before the shuffle."""
    return _one_per_key(df.filter(_name(key).isNotNull()), key, hot, lambda row: F.max_by(row, _latest_value(order)))
