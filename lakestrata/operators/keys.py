"""Surrogate keys: dense, increasing across loads, assigned in parallel."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.session import materialize

# monotonically_increasing_id() keeps the partition above bit 33, the row below.
ROW_BITS = 33
COPY = "_copy"


def highest(df: DataFrame, key: str) -> int:
    """Largest surrogate key in use, 0 for an empty table."""
    return df.agg(F.max(key).alias("top")).first()["top"] or 0


def long_array(values: Iterable[int]) -> Column:
    """A literal array of many longs: one text, folded into one literal when planned."""
    text = ",".join(map(str, values))
    if not text:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(text), ",").cast("array<bigint>")


def number_rows(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Append ``name`` = start+1, start+2, ... in partition and row order, no shuffle.

    The rows are written once with their place in their partition; only one count
    per partition reaches the driver, and goes back as an array looked up by partition,
    so that reading the keys is a projection.  A rerun task reads the written place, so
    keys cannot change under retries.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed = materialize(placed, compression="zstd")
    part = F.shiftright("_place", ROW_BITS).cast("int")
    within = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = dict(placed.groupBy(part).agg(F.count(F.lit(1))).collect())
    counts = [sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)]
    before = long_array(accumulate([start, *counts[:-1]]))
    return placed.withColumn(name, F.get(before, part) + within + 1).drop("_place")


def with_place(df: DataFrame) -> DataFrame:
    """Add ``_copy``, a number of its own for each row, for writing with the rows."""
    return df.withColumn(COPY, F.monotonically_increasing_id())


def assign_keys(
    df: DataFrame, name: str, start: int = 0, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Give every row a new surrogate key above ``start``.

    Without ``order_by`` rows are numbered where they are, with no shuffle.  With it,
    keys follow that order: rows are range-partitioned on it and on ``_copy``, a
    written number per row, so even many equal rows spread over several ranges.  A
    table that was written ``with_place`` brings it along; else it is added here.
    """
    if order_by:
        if COPY not in df.columns:
            df = materialize(with_place(df), compression="zstd")
        order = [*order_by, COPY]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return number_rows(df.drop(COPY), name, start)
