"""Audit rows of load steps, and the reports on them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.scalar import seconds_between, ts
from lakestrata.session import shuffles_freed

SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.LongType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("task_layer", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_deleted", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("duration_seconds", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class Step:
    """What a step is called in the audit log."""

    task: str
    layer: str
    operation: str
    target: str


def audit_row(
    spark: SparkSession,
    audit_id: int,
    run_id: str,
    step: Step,
    start: datetime,
    end: datetime,
    inserted: int = 0,
    updated: int = 0,
    deleted: int = 0,
    status: str = SUCCESS,
    error: str | None = None,
) -> DataFrame:
    """One audit row, ready to append."""
    seconds = int(end.replace(microsecond=0).timestamp() - start.replace(microsecond=0).timestamp())
    row = (
        audit_id,
        run_id,
        step.task,
        step.layer,
        step.operation,
        step.target,
        inserted,
        updated,
        deleted,
        status,
        error or None,
        start,
        end,
        seconds,
        end,
    )
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def audit_summary(log: DataFrame) -> DataFrame:
    """One row per run: span, totals, and FAILED over all-SKIPPED over SUCCESS."""
    total = log.groupBy("pipeline_run_id").agg(
        F.min("start_time").alias("pipeline_start"),
        F.max("end_time").alias("pipeline_end"),
        F.count(F.lit(1)).alias("total_operations"),
        F.sum("rows_inserted").alias("total_inserted"),
        F.sum("rows_updated").alias("total_updated"),
        F.sum("rows_deleted").alias("total_deleted"),
        F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("status") == SKIPPED, 1).otherwise(0)).alias("skipped"),
    )
    return total.select(
        "pipeline_run_id",
        "pipeline_start",
        "pipeline_end",
        seconds_between("pipeline_start", "pipeline_end").alias("total_duration_sec"),
        "total_operations",
        "total_inserted",
        "total_updated",
        "total_deleted",
        F.when(F.col("failed") > 0, FAILED)
        .when(F.col("skipped") == F.col("total_operations"), SKIPPED)
        .otherwise(SUCCESS)
        .alias("overall_status"),
    ).orderBy(F.desc_nulls_first("pipeline_start"), "pipeline_run_id")


def recent_steps(
    log: DataFrame,
    now: datetime,
    tasks: Sequence[str] | None = None,
    days: int = 1,
    limit: int | None = 50,
) -> DataFrame:
    """Steps of the last days, newest first; ties in task then id order."""
    since = ts(now) - F.make_dt_interval(days=F.lit(days))
    out = log.where(F.col("start_time") >= since)
    if tasks is not None:
        out = out.where(F.col("task_name").isin(list(tasks)))
    out = out.orderBy(
        F.desc_nulls_first("start_time"),
        F.asc_nulls_last("task_name"),
        F.asc_nulls_last("audit_id"),
    )
    if limit is not None:
        out = out.limit(limit)
    return out.select(
        "task_name",
        "status",
        "start_time",
        "end_time",
        seconds_between("start_time", "end_time").alias("duration_sec"),
        "error_message",
    )


def _rows(column: str, *kinds: str):
    return F.count_if(F.col(column).isin(list(kinds)))


def count_columns(columns: Sequence[str], step: Step) -> list[Column]:
    """The three counts of a step over its changes, as its kind of step reports them.

    Staging: merged rows, nothing, deleted rows.  Dimension: new versions of
    changed keys, then closed plus first versions, nothing.  Fact: merged rows,
    re-validated rows, invalidated rows.
    """
    if "_validity" in columns:
        counts = {
            "rows_inserted": _rows("_op", "insert", "update"),
            "rows_updated": _rows("_validity", "revalidated"),
            "rows_deleted": _rows("_validity", "invalidated"),
        }
    elif step.operation.startswith("SCD2"):
        counts = {
            "rows_inserted": _rows("_op", "reopen"),
            "rows_updated": _rows("_op", "close", "insert"),
        }
    else:
        counts = {
            "rows_inserted": _rows("_op", "insert", "update"),
            "rows_deleted": _rows("_op", "delete"),
        }
    zero = F.sum(F.lit(0).cast("bigint"))
    names = ("rows_inserted", "rows_updated", "rows_deleted")
    return [F.coalesce(counts.get(n, zero), F.lit(0).cast("bigint")).alias(n) for n in names]


def step_counts(changes: DataFrame, step: Step) -> DataFrame:
    """The three counts of a step, in one row."""
    return changes.agg(*count_columns(changes.columns, step))


def block_counts(spark: SparkSession, blocks: Iterable[DataFrame], step: Step) -> DataFrame:
    """The three counts of a step whose changes come block by block, one block at a time."""
    with shuffles_freed(spark):
        rows = [step_counts(b, step).first() for b in blocks]
    return _one_row(spark, {c: sum(r[c] for r in rows) for c in rows[0].asDict()})


def _one_row(spark: SparkSession, values: Mapping[str, int]) -> DataFrame:
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in values.items()])


def merge_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The three counts of a staging step whose rows per kind of change are known."""
    values = {
        "rows_inserted": counts["insert"] + counts["update"],
        "rows_updated": 0,
        "rows_deleted": counts["delete"],
    }
    return _one_row(spark, values)


class Watched:
    """The counts of a step, taken while its changes are written, in blocks or at once: no job
    of their own."""

    def __init__(self, step: Step) -> None:
        self.step, self._seen = step, []

    def __call__(self, changes: DataFrame) -> DataFrame:
        self._seen.append(Observation())
        return changes.observe(self._seen[-1], *count_columns(changes.columns, self.step))

    @property
    def counts(self) -> tuple[int, int, int]:
        """Known once the changes have been written."""
        seen = [s.get for s in self._seen]
        names = ("rows_inserted", "rows_updated", "rows_deleted")
        return tuple(sum(s[n] for s in seen) for n in names)
