"""From feed rows to raw rows, rejects and load history."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import NULL_TOKENS, STATUS_LOADED, STATUS_NEW, Entity
from lakestrata.functions.scalar import null_tokens, ts
from lakestrata.operators.merge import with_defaults
from lakestrata.sources.files import BAD, number_file_rows


LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_file_row_number", T.LongType()),
        T.StructField("_load_timestamp", T.TimestampNTZType()),
        T.StructField("bad_row", T.StringType()),
    ]
)
# What becomes of rows with too few or too many fields.
KEEP, REJECT = "keep", "reject"


def new_files(
    listed: DataFrame, ledger: DataFrame, table: str, since: datetime
) -> DataFrame:
    """Listed files whose path was not loaded into ``table`` since then, however old they are."""
    known = ledger.where((F.col("table_name") == table) & (F.col("loaded_at") >= ts(since)))
    return listed.join(known.select("path"), "path", "left_anti")


def ledger_rows(
    spark: SparkSession, listed: Iterable[Row], table: str, batch: int, run_ts: datetime
) -> DataFrame:
    """What the ledger keeps of a batch's files."""
    rows = [(table, r["path"], r["length"], r["modified"], batch, run_ts) for r in listed]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def clean_text(df: DataFrame, columns: Iterable[str], tokens=NULL_TOKENS) -> DataFrame:
    """NULL for the feed's "no value" texts, in one projection."""
    columns = set(columns)
    return df.select(
        *[null_tokens(c, tokens).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def raw_defaults(run_ts: datetime) -> dict[str, Column]:
    return {
        "_load_timestamp": ts(run_ts),
        "_source_file": F.lit(None).cast("string"),
        "_file_row_number": F.lit(None).cast("bigint"),
        "load_status": F.lit(STATUS_NEW),
    }


@dataclass(frozen=True)
class Landed:
    raw: DataFrame
    rejects: DataFrame


def _n_fields(row: Column) -> Column:
    """Fields of a row's text, NULL if its quotes do not pair up."""
    bare = F.regexp_replace(row, '"[^"]*+"', "")
    return F.when(~F.contains(bare, F.lit('"')), F.size(F.split(bare, ",")))


def is_rejected(entity: Entity, short_rows: str = REJECT, long_rows: str = REJECT) -> Column:
    """Whether a row the parser objected to stays out.  Kept short rows end in NULLs, kept
    long rows lose what is beyond the last column; rows with broken quotes never stay."""
    if not {short_rows, long_rows} <= {KEEP, REJECT}:
        raise ValueError(f"short_rows={short_rows!r}, long_rows={long_rows!r}")
    n, width = _n_fields(F.col(BAD)), len(entity.columns)
    stays = F.lit(False)
    if short_rows == KEEP:
        stays = stays | (n < width)
    if long_rows == KEEP:
        stays = stays | (n > width)
    return F.col(BAD).isNotNull() & ~F.coalesce(stays, F.lit(False))


def land(
    rows: DataFrame,
    entity: Entity,
    run_ts: datetime,
    short_rows: str = REJECT,
    long_rows: str = REJECT,
) -> Landed:
    """Number a feed's rows, then part good from bad: good ones become raw rows."""
    bad = is_rejected(entity, short_rows, long_rows)
    numbered = number_file_rows(rows)
    good = clean_text(numbered.where(~bad).drop(BAD), entity.columns)
    raw = with_defaults(good, raw_defaults(run_ts)).select(
        *entity.columns, "_load_timestamp", "_source_file", "_file_row_number", "load_status"
    )
    rejects = numbered.where(bad).select(
        "_source_file",
        "_file_row_number",
        ts(run_ts).alias("_load_timestamp"),
        F.col(BAD).alias("bad_row"),
    )
    return Landed(raw, rejects)


def load_history(
    table: str,
    raw: DataFrame,
    rejects: DataFrame,
    listed: DataFrame | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Per file and load: status, rows kept, rows rejected, the first rejected row.

    ``listed`` (_source_file) names all files of a load, so that those without rows are told too.

    Rows are combined before they are shuffled; row texts are touched only among
    the rejects.
    """
    by = ["_source_file", "_load_timestamp"]
    kept = raw.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    bad = rejects.groupBy(*by).agg(
        F.count(F.lit(1)).alias("error_count"),
        F.min_by("bad_row", "_file_row_number").alias("first_error"),
    )
    zero = F.lit(0).cast("bigint")
    both = kept.join(bad, by, "full_outer")
    if listed is not None:
        names = listed.select("_source_file", ts(run_ts).alias("_load_timestamp"))
        both = names.distinct().join(both, by, "full_outer")
    return both.select(
        F.lit(table).alias("table_name"),
        F.col("_source_file").alias("source_file"),
        F.col("_load_timestamp").alias("load_time"),
        F.when(F.col("error_count").isNull(), "LOADED")
        .when(F.coalesce("row_count", zero) == 0, "LOAD_FAILED")
        .otherwise("PARTIALLY_LOADED")
        .alias("status"),
        F.coalesce("row_count", zero).alias("row_count"),
        F.coalesce("error_count", zero).alias("error_count"),
        "first_error",
    )


def recent_loads(history: DataFrame, now: datetime, hours: int = 24) -> DataFrame:
    since = ts(now) - F.make_dt_interval(hours=F.lit(hours))
    return history.where(F.col("load_time") >= since)


def with_load_status(raw: DataFrame, consumed_batch: int | Column | None) -> DataFrame:
    """Load status by ledger: batches up to ``consumed_batch`` have reached staging.

    Raw files are never rewritten, or a stream over them would see them as new.
    """
    done = F.lit(consumed_batch) if not isinstance(consumed_batch, Column) else consumed_batch
    status = F.when(F.col("batch_id") <= done, STATUS_LOADED).otherwise(STATUS_NEW)
    return raw.withColumn("load_status", status)
