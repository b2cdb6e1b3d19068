"""Checks that report; nothing is enforced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.operators.sets import join_once


def row_counts(
    tables: Mapping[str, DataFrame], name: str = "table_name", count: str = "row_count"
) -> DataFrame:
    """One row per table."""
    out = None
    for table, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(table).alias(name), count)
        out = one if out is None else out.unionByName(one)
    return out


def count_by(df: DataFrame, column: str, count: str = "cnt") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys (NULL included) held by several rows."""
    return count_by(df, key, "row_count").where(F.col("row_count") > 1)


def orphans(fact: DataFrame, dim: DataFrame, surrogate: str) -> DataFrame:
    """Fact rows whose surrogate key is set but unknown to the dimension."""
    keys = dim.select(F.col(surrogate).alias("_sk"))
    return fact.where(F.col(surrogate).isNotNull()).join(
        keys, fact[surrogate] == keys["_sk"], "left_anti"
    )


def overlaps(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Versions valid on a day on which the next version of the key is valid too.

    The next version is the one with the next start date, then surrogate key.
    Versions with an empty range (two changes in a day) cannot overlap anything.
    The window runs over the distinct start days of a key, not over its versions,
    so a key with very many versions is no heavier than its calendar.
    """
    real = F.col("eff_end_date").isNull() | (F.col("eff_start_date") <= F.col("eff_end_date"))
    versions = dim.where(F.col(key).isNotNull() & real).select(
        key,
        surrogate,
        "eff_start_date",
        "eff_end_date",
        F.struct(key, "eff_start_date").alias("_start"),
    )
    by_day = Window.partitionBy(key).orderBy("eff_start_date")
    starts = (
        versions.groupBy(key, "eff_start_date")
        .agg(F.max(surrogate).alias("_last"))
        .select(
            F.struct(key, "eff_start_date").alias("_day"),
            "_last",
            F.lead("eff_start_date").over(by_day).alias("_next"),
        )
    )
    following = join_once(versions, starts, "_start", "_day").select(
        key,
        surrogate,
        "eff_start_date",
        "eff_end_date",
        F.when(F.col(surrogate) < F.col("_last"), F.col("eff_start_date"))
        .otherwise(F.col("_next"))
        .alias("next_start_date"),
    )
    return following.where(
        F.col("next_start_date").isNotNull()
        & (
            F.col("eff_end_date").isNull()
            | (F.col("eff_end_date") >= F.col("next_start_date"))
        )
    )


def text_limits(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows per column whose text is longer than its limit, in one pass."""
    over = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    found = over.unpivot([], list(limits), "column_name", "rows_over")
    longest = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    return found.select(
        "column_name", longest[F.col("column_name")].alias("max_length"), "rows_over"
    )


def describe(df: DataFrame) -> DataFrame:
    """Column, type and nullability of a table."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, is_nullable boolean"
    )
