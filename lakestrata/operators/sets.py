"""Membership tests with exact NULL semantics and no forced broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.keyed import null_salt


def distinct_keys(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """The non-NULL keys of ``df``.

    Map-side combining collapses a hot key before the shuffle, and the result is
    already partitioned the way a join on the key needs it.
    """
    name = name or key
    return df.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct()


def null_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows, and how many of them without a key."""
    return df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("n_null")
        ).alias("stats")
    )


def join_once(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left"
) -> DataFrame:
    """Join to a table that holds each key once, made to survive hot left keys.

    Rows of ``left`` without a key are spread over many tasks.  The salt also puts a
    shuffle of its own under each side, which adaptive execution needs to split a
    partition with a hot key; straight on top of an aggregate it cannot.
    """
    a = left.withColumn("_left_salt", null_salt(left_key))
    b = right.withColumn("_right_salt", null_salt(right_key))
    on = (a[left_key] == b[right_key]) & (a["_left_salt"] == b["_right_salt"])
    return a.join(b, on, how).drop("_left_salt", "_right_salt", right_key)


def mark_members(left: DataFrame, right: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: TRUE where the row's key is among those of ``right``, else NULL."""
    keys = distinct_keys(right, key, "_member").withColumn(flag, F.lit(True))
    return join_once(left, keys, key, "_member")


def without_members(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those of ``right``; rows without a key stay."""
    return join_once(left, distinct_keys(right, key, "_member"), key, "_member", "left_anti")


def semi_in(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None
) -> DataFrame:
    """``left_key IN (SELECT right_key FROM right)``."""
    keys = distinct_keys(right, right_key or left_key, "_member")
    keyed = left.where(F.col(left_key).isNotNull())
    return join_once(keyed, keys, left_key, "_member", "left_semi")


def anti_not_in(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None
) -> DataFrame:
    """``left_key NOT IN (SELECT right_key FROM right)``.

    An empty right side lets every row through, even without a key; a NULL on the
    right lets none through.  Written as an ordinary anti join behind two counts:
    the null-aware join Spark would pick for NOT IN always broadcasts ``right``.
    """
    right_key = right_key or left_key
    stats = null_stats(right, right_key).scalar()
    n, n_null = stats.getField("n"), stats.getField("n_null")
    open_rows = left.where((n == 0) | ((n_null == 0) & F.col(left_key).isNotNull()))
    keys = distinct_keys(right, right_key, "_member")
    return join_once(open_rows, keys, left_key, "_member", "left_anti")


def guarded_delete(target: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Drop target rows missing from the snapshot, unless the snapshot is empty.

    A NULL key in the snapshot means nothing is deleted, and target rows without a
    key always stay.  The next state keeps a row unless the delete selects it.
    """
    stats = null_stats(snapshot, key).scalar()
    blocked = (stats.getField("n") == 0) | (stats.getField("n_null") > 0)
    marked = mark_members(target, snapshot, key, "_in_snapshot")
    stays = blocked | F.col("_in_snapshot").isNotNull() | F.col(key).isNull()
    return marked.where(stays).select(*target.columns)
