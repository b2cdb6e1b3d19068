"""Clean-up: keep the row with the highest surrogate key of each natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Rows holding the largest ``surrogate`` of their key, and rows without a surrogate.

    The maximum per key is combined on the map side, so a key with many copies
    costs one row per task, where a ranking window would sort them all in one.
    Rows without a key form one group, as in a GROUP BY.
    """
    top = df.groupBy(key).agg(F.max(surrogate).alias("_top")).select("_top")
    held = df.join(top, df[surrogate] == top["_top"], "left_semi")
    return held.unionByName(df.where(F.col(surrogate).isNull()))


def keep_latest_current(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """The same among current rows only; closed versions, and rows of which it is
    not known whether they are current, are untouched."""
    current = keep_latest(dim.where(F.col("is_current")), key, surrogate)
    return dim.where(~F.coalesce("is_current", F.lit(False))).unionByName(current)


def latest_rows(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; rows without a key all stay.

    The greatest ``order`` per key is combined on the map side and joined back, so a key
    with many rows costs one row per task.  Rows equal in it all stay.
    """
    keyed = df.withColumn("_k", key).withColumn("_o", F.struct(*order))
    top = keyed.where("_k is not null").groupBy("_k").agg(F.max("_o").alias("_o"))
    last = keyed.join(top, ["_k", "_o"], "left_semi")
    return last.unionByName(keyed.where("_k is null")).drop("_k", "_o")
