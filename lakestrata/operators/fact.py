"""Fact table: surrogate-key lookups, conditional merge, soft delete, re-validation."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.config import VALID, Fact, Lookup
from lakestrata.functions.quality import valid_rows
from lakestrata.functions.scalar import changed
from lakestrata.operators.keyed import (
    IN_LEFT,
    IN_RIGHT,
    KeyStats,
    broadcast_small,
    duplicate_keys,
    in_block,
    key_blocks,
    key_stats,
    outer_on_key,
    split_on_duplicates,
)
from lakestrata.operators.keys import COPY, assign_keys, highest, with_place
from lakestrata.operators.merge import INSERT, KEEP, OP, UPDATE, all_new, merge, merge_blocks
from lakestrata.operators.scd2 import Clock, current_rows
from lakestrata.operators.sets import distinct_keys, join_once, mark_members
from lakestrata.session import materialize

VALIDITY = "_validity"
INVALIDATED, REVALIDATED = "invalidated", "revalidated"
Watch = Callable[[DataFrame], DataFrame]


def lookup_keys(
    staged: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]
) -> DataFrame:
    """Add the surrogate key of the current row of each dimension, NULL if none.

    A dimension whose keys are measured to be small is broadcast; beyond that it is a
    sort-merge left join, whose hot natural keys adaptive execution splits.
    """
    for look in lookups:
        d = current_rows(dims[look.dimension.table]).select(
            F.col(look.natural).alias("_nk"), look.surrogate
        )
        d = broadcast_small(d)
        staged = staged.join(d, staged[look.natural] == d["_nk"], "left").drop("_nk")
    return staged


def lookups_fan_out(dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> bool:
    """Whether a dimension has two current rows of one natural key."""
    found = None
    for look in lookups:
        d = current_rows(dims[look.dimension.table])
        dups = duplicate_keys(d, look.natural).select(F.lit(1))
        found = dups if found is None else found.unionAll(dups)
    return found is not None and not found.isEmpty()


def without_unread(spec: Fact, dims: Mapping[str, DataFrame], read: Collection[str]) -> Fact:
    """``spec`` without the lookups whose surrogate keys are not ``read``.  One stays where its
    dimension has two current rows of a natural key, and so repeats rows."""
    lookups = tuple(k for k in spec.lookups if k.surrogate in read or lookups_fan_out(dims, [k]))
    gone = {k.surrogate for k in spec.lookups} - {k.surrogate for k in lookups}
    kept = tuple(a for a in spec.attributes if a not in gone)
    return replace(spec, lookups=lookups, attributes=kept)


def soft_delete(fact: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """``is_valid`` off for valid rows whose key is NOT IN staging (of any quality).

    The keys are counted after the shuffle that the join needs as well, so that Spark makes it once.
    """
    count = F.count(F.lit(1))
    n_null = staged.where(F.col(key).isNull()).agg(count).scalar()
    n_keys = distinct_keys(staged, key, "_member").agg(count).scalar()
    absent = F.col("_here").isNull() & (n_null == 0) & (F.col(key).isNotNull() | (n_keys == 0))
    live = F.col("is_valid")
    return (
        mark_members(fact, staged, key, "_here")
        .withColumn("is_valid", F.when(live & absent, F.lit(False)).otherwise(live))
        .select(*fact.columns)
    )


def revalidate(fact: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """``is_valid`` on for invalidated rows whose key is IN valid staging."""
    back = ~F.col("is_valid") & F.col("_here").isNotNull()
    return (
        mark_members(fact, valid_rows(staged), key, "_here")
        .withColumn("is_valid", F.when(back, F.lit(True)).otherwise(F.col("is_valid")))
        .select(*fact.columns)
    )


def fact_changes(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    stats: tuple[KeyStats, KeyStats] | None = None,
) -> DataFrame:
    """Next state of the fact table with ``_op`` and ``_validity`` per row.

    Merge, soft delete and re-validation test the same key, so they share one full
    outer join of fact and staging.  Staged rows of any quality take part: they
    keep a fact row from counting as absent, but only valid ones change it.  ``stats``: key
    statistics, if known, of ``staged`` and of a table that holds each key at least as often
    as ``fact`` does; else they are taken here.
    """
    source, fans_out = _looked_up(staged, dims, spec)
    probe, stats = (source, None) if fans_out else (staged, stats)
    stats = stats or key_stats(fact, probe, spec.key)
    return _block_changes(fact, source, probe, spec, clock, stats)


def fact_blocks(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    stats: tuple[KeyStats, KeyStats] | None = None,
    stored: bool = True,
) -> list[DataFrame]:
    """``fact_changes`` of a stored table, as one DataFrame for each block of keys.  If there are
    several, the looked-up rows are written first; ``fact`` and they are read for each block, so
    that few rows are shuffled at a time.  Without ``stored``, ``staged`` is no stored table: what
    is looked up is written before its keys are counted."""
    source, fans_out = _looked_up(staged, dims, spec)
    probe, stats = (source, None) if fans_out else (staged, stats)
    if not (stored or stats):
        probe = source = materialize(source, compression="zstd")
    stats = stats or key_stats(fact, probe, spec.key)
    n = key_blocks(fact, source, spec.key, stats)
    if n > 1 and (stored or probe is staged):
        probe = source = materialize(source, compression="zstd")
    return [
        _block_changes(
            *[in_block(df, spec.key, i, n) for df in (fact, source, probe)], spec, clock, stats
        )
        for i in range(n)
    ]


def _looked_up(
    staged: DataFrame, dims: Mapping[str, DataFrame], spec: Fact
) -> tuple[DataFrame, bool]:
    """Staged rows with their surrogate keys, and whether that repeats rows, as it does only
    where a dimension has two current rows."""
    return lookup_keys(staged, dims, spec.lookups), lookups_fan_out(dims, spec.lookups)


def _block_changes(
    fact: DataFrame,
    source: DataFrame,
    probe: DataFrame,
    spec: Fact,
    clock: Clock,
    stats: tuple[KeyStats, KeyStats],
) -> DataFrame:
    """The changes among these rows; ``stats`` are of all rows of both tables."""
    split = split_on_duplicates(fact, source, spec.key, probe_right=probe, stats=stats)
    n, n_null = F.lit(split.right_stats.n), F.lit(split.right_stats.n_null)

    here, there = F.col(IN_LEFT).isNotNull(), F.col(IN_RIGHT).isNotNull()
    good = there & (F.col("r.data_quality_flag") == VALID)
    absent = here & ~there & ((n == 0) | ((n_null == 0) & F.col(f"l.{spec.key}").isNotNull()))
    # Tests get a projection of their own, or each column would carry a copy of them.
    joined = (
        outer_on_key(split.left, split.right, spec.key)
        .where(here | good)
        .select(
            "*",
            here.alias("_old"),
            (here & good & changed("l", "r", spec.compare)).alias("_hit"),
            (F.col("l.is_valid") & absent).alias("_off"),
            (~F.col("l.is_valid") & good).alias("_on"),
        )
    )
    old, hit, off, on = (F.col(c) for c in ("_old", "_hit", "_off", "_on"))

    columns = []
    for f in fact.schema.fields:
        c = f.name
        fresh = {"is_valid": F.lit(True), "_load_timestamp": clock.now}.get(c)
        if fresh is None:
            fresh = F.col(f"r.{c}") if c in spec.attributes or c == spec.key else F.lit(None)
        value = F.when(~old, fresh)
        if c in spec.attributes:
            value = value.when(hit, F.col(f"r.{c}"))
        if c == "is_valid":
            value = value.when(off, F.lit(False)).when(on, F.lit(True))
        columns.append(value.otherwise(F.col(f"l.{c}")).cast(f.dataType).alias(c))
    out = joined.select(
        *columns,
        F.when(~old, INSERT).when(hit, UPDATE).otherwise(KEEP).alias(OP),
        F.when(off, INVALIDATED).when(on, REVALIDATED).alias(VALIDITY),
    )
    if split.dup_left is None:
        return out
    return out.unionByName(_literal_changes(split.dup_left, split.dup_right, spec, clock, n_null))


def _literal_changes(
    fact: DataFrame, source: DataFrame, spec: Fact, clock: Clock, n_null: Column
) -> DataFrame:
    """Merge, then validity, for keys with several rows on a side."""
    merged = merge(
        fact,
        valid_rows(source).select(spec.key, *spec.attributes),
        spec.key,
        update={c: c for c in spec.attributes},
        compare=spec.compare,
        defaults={"is_valid": F.lit(True), "_load_timestamp": clock.now},
    )
    here = source.groupBy(F.col(spec.key).alias("_k")).agg(
        F.bool_or(F.col("data_quality_flag") == VALID).alias("_any_valid")
    )
    off = F.col("is_valid") & F.col("_any_valid").isNull() & (n_null == 0)
    on = ~F.col("is_valid") & F.coalesce(F.col("_any_valid"), F.lit(False))
    marked = join_once(merged, here, spec.key, "_k").withColumn(
        VALIDITY, F.when(off, INVALIDATED).when(on, REVALIDATED)
    )
    flag = (
        F.when(F.col(VALIDITY) == INVALIDATED, F.lit(False))
        .when(F.col(VALIDITY) == REVALIDATED, F.lit(True))
        .otherwise(F.col("is_valid"))
    )
    return marked.withColumn("is_valid", flag).select(*fact.columns, OP, VALIDITY)


@dataclass(frozen=True)
class FactResult:
    """``table`` is None where kept rows were not written."""

    table: DataFrame | None
    new_rows: DataFrame
    changes: DataFrame


def differing(changes: DataFrame) -> DataFrame:
    """Changes without the rows that stay as they are."""
    moved = F.col(OP) != KEEP
    if VALIDITY in changes.columns:
        moved = moved | F.col(VALIDITY).isNotNull()
    return changes.where(moved)


def key_new_rows(
    blocks: Sequence[DataFrame],
    spec: Fact,
    columns: Sequence[str],
    start_key: int,
    order_by: Sequence[str] | None,
    path: str | None = None,
    kept: bool = True,
    watch: Watch | None = None,
) -> FactResult:
    """Write the changes once, block by block, then number only the inserted rows.  Without
    ``kept`` only rows that differ are written; ``watch`` sees the rows as they are written."""
    if not kept:
        blocks = [differing(b) for b in blocks]
    if order_by:
        blocks = [with_place(b) for b in blocks]
    if watch:
        blocks = [watch(b) for b in blocks]
    changes = materialize(blocks, partition_by=OP, path=path, compression="zstd")
    fresh = changes.where(F.col(OP) == INSERT).select(
        *[c for c in changes.columns if c in (*columns, COPY) and c != spec.surrogate]
    )
    keyed = assign_keys(fresh, spec.surrogate, start_key, order_by).select(*columns)
    rest = changes.where(F.col(OP) != INSERT).select(*columns)
    return FactResult(rest.unionByName(keyed) if kept else None, keyed, changes)


def fact_apply(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    start_key: int | None = None,
    order_by: Sequence[str] | None = None,
    path: str | None = None,
    kept: bool = True,
    watch: Watch | None = None,
    stored: bool = True,
) -> FactResult:
    """A cycle of the fact table; ``stored``: whether ``staged`` is a stored table."""
    if start_key is None:
        start_key = highest(fact, spec.surrogate)
    changes = fact_blocks(fact, staged, dims, spec, clock, stored=stored)
    return key_new_rows(changes, spec, fact.columns, start_key, order_by, path, kept, watch)


def fact_initial(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    start_key: int | None = None,
    order_by: Sequence[str] | None = None,
    path: str | None = None,
    load_time_as_source: bool = True,
    kept: bool = True,
    watch: Watch | None = None,
) -> FactResult:
    """First load: only ``initial_compare`` decides an update."""
    if start_key is None:
        start_key = highest(fact, spec.surrogate)
    changes = initial_blocks(fact, staged, dims, spec, clock, load_time_as_source)
    return key_new_rows(changes, spec, fact.columns, start_key, order_by, path, kept, watch)


def initial_changes(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    load_time_as_source: bool = True,
) -> DataFrame:
    """Next state of the fact table with ``_op``, inserted rows without a surrogate key.

    The feed's own definition puts the load time into ``_source_file``;
    ``load_time_as_source=False`` leaves it NULL.  Nothing can match in an empty table, so
    its rows are the lookups' and neither counted by key nor joined.
    """
    source, options = _first_rows(staged, dims, spec, clock, load_time_as_source)
    if fact.isEmpty():
        return all_new(fact, source, options["defaults"])
    return merge(fact, source, spec.key, **options)


def initial_blocks(
    fact: DataFrame,
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    load_time_as_source: bool = True,
) -> list[DataFrame]:
    """``initial_changes`` of a stored table, as one DataFrame for each block of keys; the
    looked-up rows are written first if any can match."""
    source, options = _first_rows(staged, dims, spec, clock, load_time_as_source)
    if fact.isEmpty():
        return [all_new(fact, source, options["defaults"])]
    return merge_blocks(fact, materialize(source, compression="zstd"), spec.key, **options)


def _first_rows(
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: Fact,
    clock: Clock,
    load_time_as_source: bool,
) -> tuple[DataFrame, dict]:
    """What a first load merges, and how."""
    source = lookup_keys(valid_rows(staged), dims, spec.lookups)
    label = F.date_format("_load_timestamp", "yyyy-MM-dd HH:mm:ss.SSS")
    source = source.select(
        spec.key,
        *spec.attributes,
        (label if load_time_as_source else F.lit(None).cast("string")).alias("_source_file"),
    )
    return source, {
        "update": {**{c: c for c in spec.initial_update}, "_load_timestamp": clock.now},
        "compare": spec.initial_compare,
        "defaults": {"is_valid": F.lit(True), "_load_timestamp": clock.now},
    }


def validity_counts(changes: DataFrame) -> DataFrame:
    return changes.where(F.col(VALIDITY).isNotNull()).groupBy(VALIDITY).agg(
        F.count(F.lit(1)).alias("n")
    )

