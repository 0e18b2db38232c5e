"""Task rows from the nested result and manifest documents that a model build writes.

Both inputs hold one document per run. Each is read once, and everything between the nodes of a run is settled within its documents:
parents are looked up in their manifest, which is then cut down to the models of the stage, and the documents of a run meet in one
shuffle. Only the tasks that come out are unfolded to rows, so a manifest is never copied along with each result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratiform.functions.dates import wall_clock

_TEXT = T.StringType()

RESULTS_SCHEMA = T.StructType([
    T.StructField("run_id", _TEXT),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("unique_id", _TEXT),
        T.StructField("status", _TEXT),
        T.StructField("timing", T.ArrayType(T.StructType([
            T.StructField("started_at", _TEXT),
            T.StructField("completed_at", _TEXT),
        ]))),
        T.StructField("execution_time", T.DoubleType()),
        # Whole numbers only: text and fractions are read as NULL.
        T.StructField("adapter_response", T.StructType([T.StructField("rows_affected", T.LongType())])),
        T.StructField("relation_name", _TEXT),
        T.StructField("message", _TEXT),
    ]))),
])
_NODE = T.StructType([
    T.StructField("resource_type", _TEXT),
    T.StructField("schema", _TEXT),
    T.StructField("database", _TEXT),
    T.StructField("name", _TEXT),
    T.StructField("alias", _TEXT),
    T.StructField("identifier", _TEXT),
    T.StructField("relation_name", _TEXT),
    T.StructField("original_file_path", _TEXT),
    T.StructField("depends_on", T.StructType([T.StructField("nodes", T.ArrayType(_TEXT))])),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", _TEXT),
    T.StructField("nodes", T.MapType(_TEXT, _NODE)),
    T.StructField("sources", T.MapType(_TEXT, _NODE)),
])


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _bare(c: Column) -> Column:
    return _filled(F.replace(c, F.lit('"'), F.lit("")))


def _relation(node: Column) -> Column:
    """The stated relation name without quotes, or the parts that exist joined by dots."""
    part = {c: _filled(node[c]) for c in ("database", "schema", "alias", "identifier", "name")}
    named = F.concat_ws(".", part["database"], part["schema"], F.coalesce(part["alias"], part["identifier"], part["name"]))
    return F.coalesce(_bare(node["relation_name"]), _filled(named))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once for a row, as a lambda's argument, however often ``use`` looks at it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _index(entries: Column) -> Column:
    """Entries, whose first field is ``id``, in order, and the steps of a search by halves: the powers of two, the largest first."""
    bits = F.sequence(F.length(F.bin(F.size(entries))) - 1, F.lit(0), F.lit(-1))
    steps = F.transform(bits, lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.struct(F.sort_array(entries).alias("entries"), steps.alias("steps"))


def _meet(items: Column, key: Callable[[Column], Column], index: Column) -> Column:
    """The items whose id has an entry, each with the last such entry."""

    def last(item: Column) -> Column:
        further = lambda at, step: F.when(F.get(index["entries"], at + step - 1)["id"] <= key(item), at + step).otherwise(at)
        return F.get(index["entries"], F.aggregate(index["steps"], F.lit(0), further) - 1)

    near = F.transform(items, lambda i: F.struct(i.alias("item"), last(i).alias("entry")))
    return F.filter(near, lambda p: p["entry"]["id"] == key(p["item"]))


def _models(stage: str) -> Column:
    """The models of one stage in a manifest, with the relations of their parents."""

    def entries(kind: str, is_node: bool) -> Column:
        present = F.filter(F.map_entries(kind), lambda e: e["value"].isNotNull())
        return F.transform(present, lambda e: F.struct(
            e["key"].alias("id"), F.lit(is_node).alias("is_node"), _relation(e["value"]).alias("relation")))

    def model(entry: Column, known: Column) -> Column:
        node = entry["value"]
        parents = F.transform(_meet(node["depends_on"]["nodes"], lambda p: p, known), lambda p: p["entry"]["relation"])
        return F.struct(
            entry["key"].alias("id"), node["name"].alias("task_name"), node["original_file_path"].alias("source_file"),
            _relation(node).alias("node_relation"), F.array_sort(F.array_distinct(F.array_compact(parents))).alias("parents"),
        )

    staged = F.filter(
        F.map_entries("nodes"), lambda e: (e["value"]["resource_type"] == "model") & (e["value"]["schema"] == stage)
    )
    # A parent is looked up among the nodes first, then among the sources: of one id the node comes last.
    both = F.flatten(F.array_compact(F.array(entries("nodes", True), entries("sources", False))))
    return _once(_index(both), lambda known: F.transform(staged, lambda e: model(e, known)))


def flatten_build_logs(results: DataFrame, manifests: DataFrame, stage: str, zone: str = "+08:00") -> DataFrame:
    """One row per model of one stage and run, and the status of the whole run next to it."""
    both = manifests.select("run_id", _models(stage).alias("models")).unionByName(
        results.select("run_id", "results"), allowMissingColumns=True
    )
    # A run's tasks come from one document, so a run is no longer than its files. A manifest that is there twice adds nothing.
    run = Window.partitionBy("run_id")
    models = F.flatten(F.collect_list("models").over(run))
    met = both.filter("run_id IS NOT NULL").repartition("run_id").withColumn("models", models).filter("results IS NOT NULL")
    tasks = _once(_index(F.col("models")), lambda known: _meet(F.col("results"), lambda r: r["unique_id"], known))
    paired = met.select("run_id", tasks.alias("tasks"))
    failed = lambda t: ~F.coalesce(t["item"]["status"].isin("success", "skipped"), F.lit(False))
    failures = F.sum(F.size(F.filter("tasks", failed))).over(run)
    tasks = paired.withColumn("failures", failures).select("run_id", "failures", F.inline("tasks").alias("result", "model"))

    raw = F.col("result.status")
    status = F.when(raw == "success", "completed").when(raw == "skipped", "skipped").otherwise("failed")
    rows = F.col("result.adapter_response.rows_affected")
    timing = F.col("result.timing")
    return tasks.select(
        "run_id",
        F.lit(stage).alias("stage_name"),
        F.coalesce("model.task_name", "model.id").alias("task_name"),
        "model.source_file",
        F.when(F.size("model.parents") > 0, F.array_join("model.parents", ", ")).alias("source_relation"),
        F.coalesce(_bare(F.col("result.relation_name")), F.col("model.node_relation")).alias("target_relation"),
        status.alias("status"),
        F.when(rows >= 0, rows).alias("rows_out"),
        F.when(status == "failed", F.col("result.message")).alias("error_message"),
        wall_clock(_filled(F.get(timing, F.lit(0))["started_at"]), zone).alias("started_at"),
        wall_clock(_filled(F.get(timing, F.size(timing) - 1)["completed_at"]), zone).alias("finished_at"),
        F.bround("result.execution_time", 0).cast("int").alias("duration_seconds"),
        F.when(F.col("failures") == 0, "completed").otherwise("partial").alias("run_status"),
    )


def run_status(tasks: DataFrame) -> DataFrame:
    """Models and failures of each run; a run with any failure is partial."""
    failed = F.count(F.when(F.col("status") == "failed", 1))
    return tasks.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("models"),
        failed.alias("failed_models"),
        F.when(failed == 0, "completed").otherwise("partial").alias("run_status"),
    )
