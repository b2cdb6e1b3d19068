"""Raw text to typed, quality-flagged staging rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.config import Entity
from lakestrata.functions.quality import quality_flag
from lakestrata.functions.scalar import ts


def _build(raw: DataFrame, parsed, columns, rules, run_ts: datetime) -> DataFrame:
    # Parsing is its own projection: Spark keeps it apart because its results are
    # used several times, so no text is parsed twice.
    return raw.withColumns(parsed).select(
        *columns,
        quality_flag(rules).alias("data_quality_flag"),
        F.col("_load_timestamp"),
        ts(run_ts).alias("_transform_timestamp"),
    )


def stage_full(raw: DataFrame, entity: Entity, run_ts: datetime) -> DataFrame:
    """Build staging anew from all raw rows."""
    return _build(raw, entity.parse(), entity.project(), entity.rules, run_ts)


def stage_delta(raw: DataFrame, entity: Entity, run_ts: datetime) -> DataFrame:
    """Type and flag one batch of raw rows for the staging merge."""
    return _build(raw, entity.delta_parse(), entity.project(), entity.delta_rules, run_ts)
