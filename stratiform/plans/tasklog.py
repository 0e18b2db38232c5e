"""Task log: rows in, out and rejected of steps that completed, failed or were skipped, appended to a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratiform.functions.dates import wall_clock
from stratiform.plans.staging import Staged
from stratiform.sources.tables import read_folder, write_folder

# The columns of the log and their types.
LOG_TYPES = {
    "run_id": "string", "stage_name": "string", "task_name": "string", "source_file": "string", "source_relation": "string",
    "target_relation": "string", "status": "string", "rows_in": "long", "rows_out": "long", "rows_rejected": "long",
    "error_message": "string", "started_at": "timestamp_ntz", "finished_at": "timestamp_ntz", "duration_seconds": "int",
}
LOG_COLUMNS = tuple(LOG_TYPES)
Buckets = tuple[int, Sequence[str]] | None


@dataclass(frozen=True)
class Task:
    """A step of a run, and the log it is recorded in; ``started`` is in UTC. A step recorded again with the same outcome and attempt
    replaces its row, so a repeated append leaves one."""

    log: str
    run_id: str
    stage: str
    name: str
    target: str
    started: dt.datetime
    source_relation: str | None = None
    source_file: str | None = None
    attempt: int = 1

    def _record(self, rows: DataFrame, status: str, **values: Column) -> None:
        """Append the one row of ``rows``; columns not given are NULL."""
        finished = max(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), self.started)
        known = {
            "run_id": F.lit(self.run_id), "stage_name": F.lit(self.stage), "task_name": F.lit(self.name),
            "source_file": F.lit(self.source_file), "source_relation": F.lit(self.source_relation),
            "target_relation": F.lit(self.target), "status": F.lit(status), "started_at": _clock(self.started),
            "finished_at": _clock(finished),
            "duration_seconds": F.lit(round((finished - self.started).total_seconds())),
        }
        cells = {**known, **values}
        row = rows.select(*[cells.get(n, F.lit(None)).cast(t).alias(n) for n, t in LOG_TYPES.items()])
        write_folder(row.coalesce(1), self.log, append=True, key="/".join([self.run_id, self.stage, self.name, str(self.attempt), status]))

    def skip(self, spark: SparkSession, reason: str) -> None:
        """Record that the step was not tried."""
        self._record(spark.range(1), "skipped", error_message=F.lit(reason))

    def run(
        self, spark: SparkSession, work: Callable[[], DataFrame], counts: Callable[[DataFrame], DataFrame], folder: str, bucket_by: Buckets = None
    ) -> DataFrame:
        """Make a table, write it to ``folder``, and record its counts; a step that raises is recorded as failed and raises on.

        The counts are taken from the written table and not from accumulators on the way, which count a task again when a lost
        executor makes Spark repeat it.
        """
        try:
            written = write_folder(work(), folder, bucket_by=bucket_by)
            row = counts(written)
        except Exception as error:
            self._record(spark.range(1), "failed", error_message=F.lit(str(error)))
            raise
        self._record(row, "completed", **{c: F.col(c) for c in row.columns})
        return written


@dataclass(frozen=True)
class Writer:
    """Writes tables below ``folder``, one subfolder a layer, and records each in the log if there is one."""

    folder: str
    log: str | None = None
    run_id: str = ""

    def task(self, layer: str, name: str) -> Task:
        return Task(self.log, self.run_id, layer, f"build_{name}", f"{layer}.{name}", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    def table(self, spark: SparkSession, layer: str, name: str, work: Callable[[], DataFrame], bucket_by: Buckets = None) -> DataFrame:
        path = f"{self.folder}/{layer}/{name}"
        if self.log is None:
            return write_folder(work(), path, bucket_by=bucket_by)
        return self.task(layer, name).run(spark, work, lambda df: df.agg(F.count(F.lit(1)).alias("rows_out")), path, bucket_by)

    def staged(self, step: Staged, name: str) -> DataFrame:
        if self.log is None:
            return step.over(write_folder(step.wide, f"{self.folder}/staged/{name}")).rows
        return log_staged(step, self.run_id, name, f"{self.folder}/staged", self.log, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def _clock(at: dt.datetime) -> Column:
    return wall_clock(F.lit(at.isoformat() + "+00:00"))


def log_staged(step: Staged, run_id: str, name: str, folder: str, log: str, at: dt.datetime) -> DataFrame:
    """Write a staged step and append its row to the log."""
    summary = F.concat(
        F.lit("dedup_summary: duplicate_groups="), F.col("duplicate_groups"),
        F.lit(", conflicting_groups="), F.col("conflicting_duplicate_groups"),
        F.lit(", potential_loss_keys="), F.col("keys_with_potential_value_loss"),
        F.lit(", recovered_keys="), F.col("keys_recovered_from_duplicates"),
        F.lit(", recovered_cells="), F.col("cells_recovered_from_duplicates"),
    )

    def counts(written: DataFrame) -> DataFrame:
        rows_in = (F.col("rows_touched") + F.col("rows_rejected")).alias("rows_in")
        return step.over(written).stats.select(rows_in, "rows_out", "rows_rejected", summary.alias("error_message"))

    task = Task(log, run_id, "staging", f"build_{name}", f"staging.{name}", at, source_relation=f"raw.{name}")
    return step.over(task.run(step.wide.sparkSession, lambda: step.wide, counts, f"{folder}/{name}")).rows


def log_landed(
    spark: SparkSession, read: Callable[[], DataFrame], run_id: str, name: str, folder: str, log: str, at: dt.datetime, source_file: str
) -> DataFrame:
    """Read and write a landed table and append its row to the log; landing rejects nothing."""

    def counts(written: DataFrame) -> DataFrame:
        n = F.count(F.lit(1))
        return written.agg(n.alias("rows_in"), n.alias("rows_out"), F.lit(0).cast("long").alias("rows_rejected"))

    task = Task(log, run_id, "ingestion", f"load_{name}", f"raw.{name}", at, source_file=source_file)
    return task.run(spark, read, counts, f"{folder}/{name}")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return read_folder(spark, log).select(*LOG_COLUMNS)
