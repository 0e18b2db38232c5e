"""Group-by-year measures and their change against the year observed before."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from stratiform.functions.measures import weighted_mean
from stratiform.functions.numbers import exact_mean, percent_change

# Functions of this module travel with the job, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def group_year_metrics(
    df: DataFrame,
    first_year: int = 1990,
    last_year: int = 2024,
    group: str = "production_company",
    year: str = "release_year",
    entity: str = "movie_id",
    first_flag: str | None = None,
    distinct_entities: bool = False,
) -> DataFrame:
    """Measures per group and year.

    Amounts of an entity listed twice in one group count twice, its number once. ``first_flag`` names a column that is true
    on one row per entity and group, so distinct entities are a plain sum and only partial aggregates are shuffled.
    ``distinct_entities`` drops repeated listings first.
    """
    rows = df.filter(F.col(year).between(first_year, last_year))
    if distinct_entities:
        rows = rows.filter(first_flag) if first_flag else rows.dropDuplicates([entity, group, year])
    revenue = F.col("revenue_amount")
    votes = F.coalesce(F.col("total_ratings"), F.lit(0)).cast("decimal(16,4)")
    counted = F.sum(F.col(first_flag).cast("long")) if first_flag else F.count_distinct(F.col(entity))
    return rows.groupBy(group, year).agg(
        counted.alias("movies_released"),
        F.round(F.sum(F.when(revenue > 0, revenue).otherwise(0)), 2).cast("decimal(28,2)").alias("total_revenue"),
        exact_mean(F.when(revenue != 0, revenue), 2).alias("avg_revenue"),
        weighted_mean(F.col("avg_rating"), F.col("total_ratings")).alias("weighted_avg_rating"),
        exact_mean(votes, 2).alias("avg_vote_count"),
        F.max("record_loaded_at").alias("record_loaded_at"),
    )


def with_prior(
    df: DataFrame, group: str, order: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Add values of the row before, in order, within the group; gaps between years do not matter.

    Meant for rows already aggregated to group and year, where a group is as long as the calendar; for raw rows, where a group may be
    most of the table, see :func:`with_prior_spread`.
    """
    before = Window.partitionBy(group).orderBy(*order)
    return df.withColumns({new: F.lag(old).over(before) for new, old in columns.items()})


def with_prior_spread(
    df: DataFrame, group: str, order: Sequence[str], columns: Mapping[str, str], partitions: int | None = None
) -> DataFrame:
    """As :func:`with_prior`, for groups of any size: rows are dealt out in ranges of group and order, which cut a large group into
    many tasks; each task looks back within its range, and one row per range is carried to the next.

    ``order`` should be total, else rows that are equal in it come in any order; NULL is least in it. ``partitions``: ranges, by default
    as many as the session's shuffle partitions.
    """
    spark = df.sparkSession
    # A fixed number, so that both readings of the ranges below have the same ones.
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in (group, *order)]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    kinds = T.StructType([T.StructField(new, df.schema[old].dataType) for new, old in columns.items()])
    place = T.StructType([T.StructField("_range", T.LongType()), T.StructField("_first", T.BooleanType())])
    back = ranged.mapInArrow(lambda x: look_back(x, group, columns), T.StructType([*df.schema.fields, *kinds.fields, *place.fields]))
    edge = T.StructType([T.StructField("_range", T.LongType()), T.StructField("_group", df.schema[group].dataType), *[T.StructField(f"_{c.name}", c.dataType) for c in kinds]])
    last = ranged.mapInArrow(lambda x: last_rows(x, group, columns), edge)
    # At most one row a range: the last row of the nearest range before that has rows.
    before = Window.orderBy("_range")
    carried = last.select(
        F.lead("_range").over(before).alias("_next"), *[c for c in last.columns if c != "_range"]
    ).where("_next IS NOT NULL")
    joined = back.join(F.broadcast(carried), F.when(F.col("_first"), F.col("_range")) == F.col("_next"), "left")
    same = F.col("_next").isNotNull() & F.col(f"`{group}`").eqNullSafe(F.col("_group"))
    cells = {new: F.when(same, F.col(f"`_{new}`")).otherwise(F.col(f"`{new}`")) for new in columns}
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(new) for new, c in cells.items()])


def look_back(batches: Iterator[pa.RecordBatch], group: str, columns: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    """Rows of one range with values of the row before in it, the range's number, and which row is its first."""
    range_, held = TaskContext.get().partitionId(), None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        groups = batch.column(group)
        first = held is None
        held = held or batch.slice(0, 1)
        earlier = pa.concat_arrays([held.column(group), groups.slice(0, n - 1)])
        same = pc.or_kleene(pc.fill_null(pc.equal(groups, earlier), False), pc.and_(pc.is_null(groups), pc.is_null(earlier)))
        if first:
            same = pa.concat_arrays([pa.array([False]), same.slice(1)])
        made = []
        for old in columns.values():
            values = pa.concat_arrays([held.column(old), batch.column(old).slice(0, n - 1)])
            made.append(pc.if_else(same, values, pa.scalar(None, values.type)))
        marks = [pa.array(np.full(n, range_)), pa.array(np.arange(n) == (0 if first else -1))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made, *marks], [*batch.schema.names, *columns, "_range", "_first"])
        held = batch.slice(n - 1, 1)


def last_rows(batches: Iterator[pa.RecordBatch], group: str, columns: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    """The last row of a range, if it has any: the range's number, the group, and the values to carry."""
    held = None
    for batch in batches:
        if batch.num_rows:
            held = batch.slice(batch.num_rows - 1, 1)
    if held is not None:
        cells = [pa.array([TaskContext.get().partitionId()], pa.int64()), held.column(group), *[held.column(old) for old in columns.values()]]
        yield pa.RecordBatch.from_arrays(cells, ["_range", "_group", *[f"_{new}" for new in columns]])


def change_measures(df: DataFrame) -> DataFrame:
    """Percent change of revenue and plain change of rating; NULL where there is nothing to compare with."""
    delta = F.col("weighted_avg_rating") - F.col("prior_year_rating")
    return df.withColumns(
        {
            "revenue_yoy_pct": percent_change(F.col("total_revenue"), F.col("prior_year_revenue")),
            "rating_yoy_delta": F.round(delta, 4).cast("decimal(28,4)"),
        }
    )


def year_over_year(metrics: DataFrame, group: str = "production_company", year: str = "release_year") -> DataFrame:
    prior = {"prior_year_revenue": "total_revenue", "prior_year_rating": "weighted_avg_rating"}
    return change_measures(with_prior(metrics, group, [year], prior))
