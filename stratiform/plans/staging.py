"""Raw tables to staged tables: collapse duplicates, fill gaps from the enrichment source, gate ratings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stratiform.functions.dates import normalise_mixed_date
from stratiform.functions.text import is_blank, nullify
from stratiform.operators.dedup import COUNTERS, collapse_duplicates, group_statistics, keep_first
from stratiform.operators.enrich import attach, fill_blank

# The columns of each raw table whose blanks are recovered and filled.
CORE_SIGNALS = ("title", "release_date", "budget", "revenue")
EXTENDED_SIGNALS = ("genres", "production_countries", "production_companies", "spoken_languages")
RATING_SIGNALS = ("avg_rating", "total_ratings", "stg_dev")

# The columns of the enrichment source.
ENRICHMENT_COLUMNS = (
    "id", "title", "release_date", "budget", "revenue", "genres", "production_companies", "production_countries",
    "spoken_languages", "vote_average", "vote_count", "status",
)


@dataclass(frozen=True)
class Staged:
    """A staged table and what it took to make it.

    ``wide`` holds the output columns and per-row counters, so it can be written once and both the table (``rows``) and the
    statistics (``stats``) read from it.
    """

    wide: DataFrame
    columns: tuple[str, ...]
    extra_stats: tuple[Column, ...] = ()

    @property
    def rows(self) -> DataFrame:
        return self.wide.filter("is_kept").select(*self.columns)

    @property
    def stats(self) -> DataFrame:
        totals = {
            "rows_out": "count_if(is_kept)",
            "rows_rejected": "coalesce(sum(n_rejected), 0) + count_if(is_dropped)",
            "rows_touched": "count_if(is_kept AND is_touched)",
            "values_filled": "coalesce(sum(n_filled), 0)",
        }
        return self.wide.agg(*[F.expr(e).alias(n) for n, e in totals.items()], *group_statistics(), *self.extra_stats)

    def over(self, wide: DataFrame) -> Staged:
        """The same step, read from where its wide form was written."""
        return Staged(wide, self.columns, self.extra_stats)


def prepare_enrichment(source: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first row per id of the enrichment source, with its date in normal form."""
    first = keep_first(source.select(*ENRICHMENT_COLUMNS, *[c for c in order if isinstance(c, str)]), "id", order)
    return first.select(*ENRICHMENT_COLUMNS).withColumn("release_date_norm", normalise_mixed_date(F.col("release_date")))


def _touched(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()


def _finish(df: DataFrame, key: str, signals: Sequence[str], loaded_at: Column) -> Staged:
    """Cells as a table stores them, blanks as NULL, with the counters next to them."""
    columns = (key, *signals, "loaded_at")
    wide = df.select(
        key,
        *[nullify(F.col(c)).alias(c) for c in signals],
        loaded_at.alias("loaded_at"),
        _touched(signals).alias("is_touched"),
        F.lit(True).alias("is_kept"),
        F.lit(False).alias("is_dropped"),
        "n_filled",
        *COUNTERS,
    )
    return Staged(wide, columns)


def stage_core(
    raw: DataFrame, enrichment: DataFrame, order: Sequence[str | Column], loaded_at: dt.datetime, hot: Sequence = ()
) -> Staged:
    """Core attributes: titles and amounts are filled as they came, dates are brought to one form first."""
    kept = collapse_duplicates(raw, "id", order, CORE_SIGNALS, True, ["id", *CORE_SIGNALS], hot)
    joined = attach(kept, enrichment, "id", ["title", "budget", "revenue", "release_date_norm"])
    filled = fill_blank(joined, {c: f"{c}_src" for c in ("title", "budget", "revenue")}, "n_filled")
    dated = filled.withColumn("release_date", normalise_mixed_date(F.col("release_date")))
    done = fill_blank(dated, {"release_date": "release_date_norm_src"}, "n_filled")
    return _finish(done, "id", CORE_SIGNALS, F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz"))


def stage_extended(
    raw: DataFrame, enrichment: DataFrame, order: Sequence[str | Column], loaded_at: dt.datetime, hot: Sequence = ()
) -> Staged:
    """List attributes, each filled from the enrichment source."""
    kept = collapse_duplicates(raw, "id", order, EXTENDED_SIGNALS, True, ["id", *EXTENDED_SIGNALS], hot)
    joined = attach(kept, enrichment, "id", EXTENDED_SIGNALS)
    done = fill_blank(joined, {c: f"{c}_src" for c in EXTENDED_SIGNALS}, "n_filled")
    return _finish(done, "id", EXTENDED_SIGNALS, F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz"))


def stage_ratings(
    raw: DataFrame,
    core: DataFrame,
    enrichment: DataFrame,
    order: Sequence[str | Column],
    loaded_at: str,
    min_votes: int = 20,
    one_row_per_id: bool = False,
    hot: Sequence = (),
) -> Staged:
    """Ratings of the ids in the core table, raw or, with ``one_row_per_id``, staged; gaps are filled from released enrichment rows with enough votes.

    Rows with neither rating nor count are dropped. Collapsed ratings of ids outside the core table count as rejected
    duplicates only, so they stay in the wide form as rows that are neither kept nor dropped.
    """
    ids = core.select(F.col("id").alias("core_id"))
    universe = (ids if one_row_per_id else ids.distinct()).withColumn("in_core", F.lit(True))
    own = collapse_duplicates(
        raw, "movie_id", order, RATING_SIGNALS, True, ["movie_id", *RATING_SIGNALS, "loaded_at"], hot
    )
    votes = enrichment.select(F.col("id").alias("movie_id"), "vote_average", "vote_count", "status")
    # Rows without a key are one entity on either side, so NULL meets NULL.
    met = universe.join(own, F.col("core_id").eqNullSafe(F.col("movie_id")), "full_outer")
    joined = met.withColumn("movie_id", F.coalesce("core_id", "movie_id")).join(votes, "movie_id", "left")

    in_core = F.coalesce(F.col("in_core"), F.lit(False))
    matched = in_core & F.col("status").isNotNull()
    passes = matched & (F.lower("status") == "released") & (F.col("vote_count").try_cast("double") >= min_votes)
    passes = F.coalesce(passes, F.lit(False))
    gated = joined.withColumns(
        {
            "in_core": in_core,
            "is_matched": matched,
            "is_valid": passes,
            "gate_rating": F.when(passes, F.col("vote_average")),
            "gate_votes": F.when(passes, F.col("vote_count")),
        }
    )
    filled = fill_blank(gated, {"avg_rating": "gate_rating", "total_ratings": "gate_votes"}, "n_filled")
    empty = is_blank(F.col("avg_rating")) & is_blank(F.col("total_ratings"))
    columns = ("movie_id", *RATING_SIGNALS, "loaded_at")
    wide = filled.select(
        "movie_id",
        *[nullify(F.col(c)).alias(c) for c in RATING_SIGNALS],
        F.coalesce(nullify(F.col("loaded_at")), F.lit(loaded_at)).alias("loaded_at"),
        F.lit(True).alias("is_touched"),
        (F.col("in_core") & ~empty).alias("is_kept"),
        (F.col("in_core") & empty).alias("is_dropped"),
        F.when(F.col("in_core"), F.col("n_filled")).otherwise(0).alias("n_filled"),
        *COUNTERS,
        "is_matched",
        "is_valid",
    )
    gate = (
        F.expr("count_if(is_matched)").alias("enrichment_matched"),
        F.expr("count_if(is_matched AND NOT is_valid)").alias("enrichment_rejected"),
    )
    return Staged(wide, columns, gate)
