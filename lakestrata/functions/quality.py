"""Quality flag: the first rule a row fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.config import VALID, Rule


def quality_flag(rules: Sequence[Rule]) -> Column:
    """First failing rule wins; rules see the untrimmed input columns."""
    return F.coalesce(*[F.when(failed(), flag) for flag, failed in rules], F.lit(VALID))


def valid_rows(df: DataFrame, flag: str = "data_quality_flag") -> DataFrame:
    """Where staging is not written first, the test must not be pushed below the parsing, or
    each text is parsed for the test and again for its value; ``_row`` holds it in place."""
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    return placed.where((F.col(flag) == VALID) & (F.col("_row") >= 0)).drop("_row")


def quality_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and flag."""
    parts = [
        df.groupBy("data_quality_flag")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit(name).alias("table_name"), "data_quality_flag", "cnt")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(F.asc_nulls_last("table_name"), F.asc_nulls_last("data_quality_flag"))
