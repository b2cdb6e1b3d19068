"""Upsert of a snapshot or delta into a keyed table, as the table's next state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakestrata.functions.scalar import changed
from lakestrata.operators.keyed import (
    IN_LEFT,
    IN_RIGHT,
    DuplicateKeyError,
    KeyStats,
    count_keys,
    duplicate_keys,
    in_block,
    key_blocks,
    key_stats,
    outer_on_key,
    split_on_duplicates,
)
from lakestrata.operators.sets import mark_members, semi_in, without_members

OP = "_op"
INSERT, UPDATE, DELETE, KEEP = "insert", "update", "delete", "keep"


def duplicate_updates(
    target: DataFrame, source: DataFrame, key: str, compare: Sequence[str] | None = None
) -> DataFrame:
    """Keys for which more than one source row would update the same target row.

    With ``compare`` only source rows that differ from the target row count.
    Copies are collapsed into counts first, so a hot key costs one row per
    distinct version of it.
    """
    counts = duplicate_keys(source, key)
    if compare is None:
        return semi_in(counts, target, key).select(key, F.col("n").alias("source_rows"))
    versions = (
        semi_in(source, counts, key)
        .groupBy(key, *compare)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    held = semi_in(target.select(key, *compare), counts, key).distinct()
    per_target = (
        held.alias("t")
        .join(versions.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"))
        .where(changed("t", "s", compare))
        .groupBy(*[F.col(f"t.{c}").alias(c) for c in (key, *compare)])
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 1)
    )
    return per_target.groupBy(key).agg(F.max("n").alias("source_rows"))


def single_versions(source: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Source rows whose key and compared values no other row shares.

    Once ``duplicate_updates`` is empty only these can still update anything: a
    version held twice would have updated a differing target row twice.
    """
    single = (
        source.groupBy(key, *compare)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 1)
        .alias("v")
    )
    same = F.col(f"s.{key}") == F.col(f"v.{key}")
    for c in compare:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"v.{c}"))
    return source.alias("s").join(single, same, "left_semi")


def raise_on_duplicate_updates(
    target: DataFrame, source: DataFrame, key: str, compare: Sequence[str] | None = None
) -> None:
    found = duplicate_updates(target, source, key, compare).limit(3).collect()
    if found:
        keys = ", ".join(str(r[key]) for r in found)
        raise DuplicateKeyError(f"several source rows match one row by {key}: {keys}, ...")


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Mapping[str, str | Column] | None = None,
    compare: Sequence[str] | None = None,
    defaults: Mapping[str, Column] | None = None,
    delete_missing: bool = False,
    whole_deletes: bool = True,
    stats: tuple[KeyStats, KeyStats] | None = None,
) -> DataFrame:
    """Next state of ``target`` plus ``_op`` (what happened to the row).

    ``update``: columns set on a match, from a source column or an expression;
    default every shared column but the key.  ``compare``: update only where one
    of these differs (NULL is no difference).  ``defaults``: values of inserted
    columns the source lacks.  ``delete_missing`` marks target rows absent from the
    source as deleted in the same join, under the guards of ``guarded_delete``.
    ``whole_deletes=False``: deleted rows need hold no more than their key.  Where the source
    then gives every value that stays, only keys of ``target`` are shuffled.

    ``stats``: key statistics of both sides, or of tables these are blocks of, if known.

    Rows without a key never match: target ones stay, source ones are inserted
    each time.  Several source rows updating one target row raise
    ``DuplicateKeyError``; several rows of a new key are all inserted.
    """
    columns = target.columns
    if update is None:
        update = {c: c for c in source.columns if c in columns and c != key}
    defaults = dict(defaults or {})
    split = split_on_duplicates(target, source, key, stats=stats)
    deleting = delete_missing and _may_delete(split.right_stats)
    guard = F.lit(deleting)

    left = split.left
    replaced = compare is None and all(
        isinstance(update.get(c), str) for c in columns if c != key
    )
    keys_only = deleting and replaced and not whole_deletes
    if keys_only:  # a row with a key is updated or deleted; one without stays and meets nothing
        left = left.where(F.col(key).isNotNull()).select(key)
    joined = outer_on_key(left, split.right, key)
    types = {f.name: f.dataType for f in target.schema.fields}
    out = _resolve(
        joined, types, left.columns, source.columns, key, update, compare, defaults, guard
    )
    if keys_only and split.left_stats.n_null:
        unkeyed = split.left.where(F.col(key).isNull())
        out = out.unionByName(unkeyed.withColumn(OP, F.lit(KEEP)))
    if split.dup_right is None:
        return out

    t, s = split.dup_left, split.dup_right
    raise_on_duplicate_updates(t, s, key, compare)
    # A matched key now has one updating source row at most, so left join; a new
    # key's rows are plain inserts.  Both joins are of kinds AQE can split.
    candidates = single_versions(s, key, compare) if compare else s
    updating = mark_members(t, s, key, "_in_source").alias("l").join(
        candidates.select("*", F.lit(True).alias("_here")).alias("r"),
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (changed("l", "r", compare) if compare else F.lit(True)),
        "left",
    )
    hit = F.col(IN_RIGHT).isNotNull()
    gone = F.col("_in_source").isNull() & guard
    kept = updating.select(
        *[
            F.when(hit, _value(update[c])).otherwise(F.col(f"l.{c}")).alias(c)
            if c in update
            else F.col(f"l.{c}").alias(c)
            for c in columns
        ],
        F.when(hit, UPDATE).when(gone, DELETE).otherwise(KEEP).alias(OP),
    )
    fresh = all_new(target, without_members(s, t, key), defaults)
    return out.unionByName(kept).unionByName(fresh)


def merge_blocks(target: DataFrame, source: DataFrame, key: str, **options) -> list[DataFrame]:
    """``merge`` of two stored tables, as one DataFrame for each block of keys: they are read as
    often as there are blocks, so that few rows are shuffled at a time."""
    stats = key_stats(target, source, key)
    n = key_blocks(target, source, key, stats)
    return [
        merge(in_block(target, key, i, n), in_block(source, key, i, n), key, stats=stats, **options)
        for i in range(n)
    ]


def all_new(target: DataFrame, source: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Every source row as an inserted row of ``target``: what ``merge`` makes of keys that
    ``target`` lacks, hence of all rows if it is empty."""
    return source.select(
        *[
            (F.col(f.name) if f.name in source.columns else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ],
        F.lit(INSERT).alias(OP),
    )


def _value(item: str | Column) -> Column:
    return F.col(f"r.{item}") if isinstance(item, str) else item


def _may_delete(source: KeyStats) -> bool:
    return source.n > 0 and source.n_null == 0


def _resolve(
    joined: DataFrame,
    types: Mapping[str, DataType],
    target_columns: Sequence[str],
    source_columns: Sequence[str],
    key: str,
    update: Mapping[str, str | Column],
    compare: Sequence[str] | None,
    defaults: Mapping[str, Column],
    guard: Column,
) -> DataFrame:
    here, there = F.col(IN_LEFT).isNotNull(), F.col(IN_RIGHT).isNotNull()
    # Tests get a projection of their own, or each column would carry a copy of them.
    joined = joined.select(
        "*",
        here.alias("_old"),
        (here & there & (changed("l", "r", compare) if compare else F.lit(True))).alias("_hit"),
        (here & ~there & guard & F.col(f"l.{key}").isNotNull()).alias("_gone"),
    )
    old, hit, gone = F.col("_old"), F.col("_hit"), F.col("_gone")
    out = []
    for c, kind in types.items():
        fresh = F.col(f"r.{c}") if c in source_columns else defaults.get(c, F.lit(None))
        value = F.when(~old, fresh)
        if c in update:
            value = value.when(hit, _value(update[c]))
        if c in target_columns:
            value = value.otherwise(F.col(f"l.{c}"))
        out.append(value.cast(kind).alias(c))
    op = (
        F.when(~old, INSERT).when(hit, UPDATE).when(gone, DELETE).otherwise(KEEP).alias(OP)
    )
    return joined.select(*out, op)


def snapshot_counts(
    target: DataFrame, source: DataFrame, key: str
) -> tuple[dict[str, int], tuple[KeyStats, KeyStats]]:
    """Rows per kind of change of ``merge(..., delete_missing=True)`` without ``compare``, and
    the key statistics of both sides, by one grouped pass over the keys, with no row moved.
    """
    n0, n1, has_key = F.col("n0"), F.col("n1"), F.col("k").isNotNull()
    met = has_key & (n0 > 0) & (n1 > 0)
    found, stats = count_keys(
        target,
        source,
        key,
        insert=F.sum(F.when(~has_key | (n0 == 0), n1)),
        update=F.sum(F.when(met, n0)),
        missing=F.sum(F.when(has_key & (n1 == 0), n0)),
        unkeyed=F.sum(F.when(~has_key, n0)),
        refused=F.count_if(met & (n1 > 1)),
    )
    if found["refused"]:
        raise_on_duplicate_updates(target, source, key)
    deleting = _may_delete(stats[1])
    counts = {
        INSERT: found["insert"],
        UPDATE: found["update"],
        DELETE: found["missing"] if deleting else 0,
        KEEP: found["unkeyed"] + (0 if deleting else found["missing"]),
    }
    return counts, stats


def state(changes: DataFrame) -> DataFrame:
    """The table after the change."""
    return changes.where(F.col(OP) != DELETE).drop(OP)


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per kind of change."""
    return changes.groupBy(OP).agg(F.count(F.lit(1)).alias("n"))


def add_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add a column with a default, unless it is there."""
    return df if name in df.columns else df.withColumn(name, default)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    for name, value in defaults.items():
        df = add_column(df, name, value)
    return df
