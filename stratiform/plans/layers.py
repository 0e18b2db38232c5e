"""All layers from raw tables to the scorecard, written in order, tested as they are written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame

from stratiform.functions.measures import REPAIR_FLAGS
from stratiform.operators.checks import Declared, run_checks
from stratiform.operators.dimensions import attribute_dimension, date_dimension, date_spine, name_dimension
from stratiform.operators.facts import group_year_fact, rating_fact
from stratiform.operators.metrics import group_year_metrics, year_over_year
from stratiform.operators.scorecard import ScoreRules, scorecard, trend_bands
from stratiform.operators.scaling import known_statistics, statistics
from stratiform.plans.bridge import base_join, company_bridge
from stratiform.plans.staging import Staged, prepare_enrichment, stage_core, stage_extended, stage_ratings
from stratiform.plans.tasklog import Writer
from stratiform.plans.typed import ratings_on_one_scale, scored_ratings, typed_core, typed_extended, typed_ratings

FIRST = "is_first_listing"


@dataclass(frozen=True)
class Inputs:
    """Raw tables with the columns that tell their row order, and the ids of each that have too many rows for one task (``hot_keys``)."""

    core: DataFrame
    extended: DataFrame
    ratings: DataFrame
    enrichment: DataFrame
    core_order: Sequence[str | Column]
    extended_order: Sequence[str | Column]
    ratings_order: Sequence[str | Column]
    enrichment_order: Sequence[str | Column]
    core_hot: Sequence = ()
    extended_hot: Sequence = ()
    ratings_hot: Sequence = ()


@dataclass(frozen=True)
class Settings:
    """``buckets``: of every typed table, by entity key, so that they join without a shuffle; None: as many as the session's shuffle
    partitions when they are written."""

    loaded_at: dt.datetime
    today: dt.date
    min_votes: int = 20
    metric_years: tuple[int, int] = (1990, 2024)
    rules: ScoreRules = field(default_factory=ScoreRules)
    buckets: int | None = None


def staged_table(
    name: str, inputs: Inputs, settings: Settings, extra: DataFrame | None = None, core: DataFrame | None = None
) -> Staged:
    """One staged table; ``extra`` is the prepared enrichment source and ``core`` the staged core, where they are at hand."""
    extra = extra or prepare_enrichment(inputs.enrichment, inputs.enrichment_order)
    if name == "movies_main":
        return stage_core(inputs.core, extra, inputs.core_order, settings.loaded_at, inputs.core_hot)
    if name == "movie_extended":
        return stage_extended(inputs.extended, extra, inputs.extended_order, settings.loaded_at, inputs.extended_hot)
    iso = settings.loaded_at.isoformat() + "+00:00"
    known = inputs.core if core is None else core
    return stage_ratings(inputs.ratings, known, extra, inputs.ratings_order, iso, settings.min_votes, core is not None, inputs.ratings_hot)


STAGED = ("movies_main", "movie_extended", "ratings")


def staged_tables(inputs: Inputs, settings: Settings, names: Sequence[str] = STAGED) -> dict[str, Staged]:
    extra = prepare_enrichment(inputs.enrichment, inputs.enrichment_order)
    return {name: staged_table(name, inputs, settings, extra) for name in names}


def typed_tables(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The typed form of each staged table given."""
    forms = {"movies_main": typed_core, "movie_extended": typed_extended, "ratings": typed_ratings}
    return {f"stg_{name}": forms[name](df) for name, df in staged.items()}


def bridge_table(typed: dict[str, DataFrame]) -> DataFrame:
    base = base_join(typed["stg_movies_main"], typed["stg_movie_extended"], typed["stg_ratings"])
    return company_bridge(base, first_flag=FIRST)


def metrics_table(bridge: DataFrame, settings: Settings) -> DataFrame:
    return year_over_year(group_year_metrics(bridge, *settings.metric_years, first_flag=FIRST))


class Models(Mapping):
    """Every model by name as a lazy DataFrame, its plan composed when first asked for; nothing is written."""

    def __init__(self, inputs: Inputs, settings: Settings, typed: dict[str, DataFrame] | None = None,
                 bridge: DataFrame | None = None, metrics: DataFrame | None = None):
        self._inputs, self._settings = inputs, settings
        self._made: dict[str, DataFrame] = dict(typed or {})
        if bridge is not None:
            self._made["bridge"] = bridge
        if metrics is not None:
            self._made["int_company_year_metrics"] = metrics

    def _typed(self, name: str) -> DataFrame:
        step = staged_table(name, self._inputs, self._settings, self._get("enrichment"))
        return typed_tables({name: step.rows})[f"stg_{name}"]

    def _make(self, name: str) -> DataFrame:
        get, settings = self._get, self._settings
        if name == "enrichment":
            return prepare_enrichment(self._inputs.enrichment, self._inputs.enrichment_order)
        if name.startswith("stg_"):
            return self._typed(name.removeprefix("stg_"))
        if name == "bridge":
            return bridge_table({t: get(t) for t in MODELS[:3]})
        if name == "int_movie_company_bridge":
            return get("bridge").drop(FIRST)
        if name == "int_company_year_metrics":
            return metrics_table(get("bridge"), settings)
        if name == "dim_date":
            return date_dimension(date_spine(get("stg_movies_main"), "release_date", settings.today))
        if name == "dim_movies":
            return attribute_dimension(get("stg_movies_main"), get("stg_movie_extended"))
        if name == "dim_production_companies":
            return name_dimension(get("bridge"))
        if name == "fct_movie_ratings":
            return rating_fact(get("stg_ratings"), get("dim_movies"))
        if name == "fct_company_year_performance":
            return group_year_fact(get("int_company_year_metrics"))
        fact = get("fct_company_year_performance")
        if name == "vw_company_year_trends":
            return trend_bands(fact, settings.rules)
        if name == "vw_high_value_studio_performance":
            return scorecard(fact, get("vw_company_year_trends"), settings.rules, ordered=False)
        raise KeyError(name)

    def _get(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(name)
        return self._get(name)

    def __iter__(self):
        return iter(MODELS)

    def __len__(self):
        return len(MODELS)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Use ``df``, such as the written form, for this model and all built on it from now on."""
        self._made[name] = df
        return df


MODELS = (
    "stg_movies_main", "stg_movie_extended", "stg_ratings", "int_movie_company_bridge", "int_company_year_metrics",
    "dim_date", "dim_movies", "dim_production_companies", "fct_movie_ratings", "fct_company_year_performance",
    "vw_company_year_trends", "vw_high_value_studio_performance",
)


# The declared tests of each layer.
DECLARED = {
    "staging": {
        name: Declared(not_null=["movie_id"], unique=["movie_id"])
        for name in ("stg_movies_main", "stg_movie_extended", "stg_ratings")
    },
    "intermediate": {
        "int_movie_company_bridge": Declared(
            not_null=["movie_id", "production_company"], accepted={"budget_correction_flag": REPAIR_FLAGS}
        ),
        "int_company_year_metrics": Declared(not_null=["production_company", "release_year"]),
    },
    "marts": {
        "dim_date": Declared(not_null=["date_key", "date_day"], unique=["date_key", "date_day"]),
        "dim_movies": Declared(
            not_null=["movie_id"], unique=["movie_id"], relationships={"release_date_key": ("dim_date", "date_key")}
        ),
        "dim_production_companies": Declared(
            not_null=["production_company_key", "production_company"], unique=["production_company_key"]
        ),
        "fct_company_year_performance": Declared(
            not_null=["production_company_key", "release_year_start_date_key", "release_year"],
            relationships={"release_year_start_date_key": ("dim_date", "date_key")},
        ),
        "fct_movie_ratings": Declared(
            not_null=["movie_id"], relationships={"release_date_key": ("dim_date", "date_key")}
        ),
    },
    "analytics": {
        "vw_company_year_trends": Declared(
            not_null=["production_company_key", "production_company", "release_year", "release_year_start_date_key"]
        ),
        "vw_high_value_studio_performance": Declared(not_null=["production_company_key", "production_company"]),
    },
}


class ChecksFailed(RuntimeError):
    """A layer broke its declared tests; later layers were not built."""


def _test_layer(layer: str, tables: Mapping[str, DataFrame], to: Writer) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    result = to.table(spark, "checks", layer, lambda: run_checks(tables, DECLARED[layer]))
    # One row per declared test, so the driver reads a list as long as the declarations.
    broken = result.filter("violations > 0").collect()
    if broken:
        raise ChecksFailed(f"{layer}: " + "; ".join(f"{r.table_name}.{r.column_name} {r.test}={r.violations}" for r in broken))
    return result


@dataclass(frozen=True)
class Built:
    """What a build wrote: staged tables, models, and the outcome of the declared tests."""

    staged: dict[str, DataFrame]
    models: Models
    checks: DataFrame


def write_typed(inputs: Inputs, settings: Settings, to: Writer) -> tuple[dict[str, DataFrame], Models]:
    """Write the staged and typed tables.

    The enrichment source is prepared and written once for all three, in buckets of its id, so joining it moves none of it; ratings take their ids from the staged core table; and
    the statistics of the rating column are taken as its one-scale form is written. Typed tables lie in the same buckets of the entity.
    """
    spark = inputs.core.sparkSession
    buckets = settings.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    extra = to.table(spark, "staged", "enrichment", lambda: prepare_enrichment(inputs.enrichment, inputs.enrichment_order), (buckets, ["id"]))
    staged: dict[str, DataFrame] = {}
    for name in STAGED:
        staged[name] = to.staged(staged_table(name, inputs, settings, extra, staged.get("movies_main")), name)
    watched, seen = statistics(ratings_on_one_scale(staged["ratings"]), "rating_10")
    one_scale = to.table(spark, "staged", "ratings_on_one_scale", lambda: watched)
    scored = scored_ratings(one_scale, known_statistics(one_scale, "rating_10", seen))
    made = {**typed_tables({n: staged[n] for n in STAGED[:2]}), "stg_ratings": scored}
    typed = {n: to.table(spark, "staging", n, lambda df=df: df, (buckets, ["movie_id"])) for n, df in made.items()}
    return staged, Models(inputs, settings, typed)


def build_layers(inputs: Inputs, settings: Settings, folder: str, log: str | None = None, run_id: str = "") -> Built:
    """Write staged, typed, intermediate and mart tables below ``folder``, and test each layer before the next is built.

    Each table is read back from where it was written, so later layers do not repeat the work of earlier ones and a lost
    executor costs no more than the table at hand; and each is published whole or not at all. The two reports stay views, as nothing
    reads them but queries. With a ``log``, every table and test is recorded there under ``run_id``.
    """
    spark, to = inputs.core.sparkSession, Writer(folder, log, run_id)
    staged, models = write_typed(inputs, settings, to)
    tested = [_test_layer("staging", models, to)]
    models.put("bridge", to.table(spark, "intermediate", "int_movie_company_bridge", lambda: models._get("bridge")))
    layers = {"intermediate": ["int_company_year_metrics"], "marts": [n for n in MODELS if n.startswith(("dim_", "fct_"))]}
    for layer, names in layers.items():
        for name in names:
            models.put(name, to.table(spark, layer, name, lambda name=name: models[name]))
        tested.append(_test_layer(layer, models, to))
    tested.append(_test_layer("analytics", models, to))
    return Built(staged, models, reduce(DataFrame.unionByName, tested))
