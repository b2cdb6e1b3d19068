"""Shared parts of operators that meet two tables on a key.

A full outer join is the cheapest way to compare a table with its next snapshot,
one shuffle a side, but Spark cannot split a hot key in it.  Only two things can
make a key hot, and both are taken out of the join here:

* rows without a key: they match nothing, so they are spread over many tasks;
* keys held by several rows on one side: found by a map-side combined count and
  handled by the caller with joins that adaptive execution can split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.session import materialize, shuffles_freed


class DuplicateKeyError(ValueError):
    """Several source rows would change one target row."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


@dataclass(frozen=True)
class KeyStats:
    """Rows of a table, those without a key, and whether a key is held by several."""

    n: int
    n_null: int
    repeated: bool


# Key types whose equal values have equal hashes, the bytes up to which a
# measured table is broadcast, and the rows of two stored tables that are shuffled at a time.
HASHED_TYPES = ("string", "bigint", "int", "smallint", "tinyint", "date")
BROADCAST_BYTES = 200_000_000
ROWS_AT_ONCE = 150_000_000


def key_stats(left: DataFrame, right: DataFrame, key: str) -> tuple[KeyStats, KeyStats]:
    """Of both tables, by one grouped pass over their keys; two rows reach the driver.

    What is grouped are 8-byte hashes: where none comes twice, no key does.  Where one does
    (a repeated key, or two keys of one hash), the keys themselves are counted.
    """
    if any(df.schema[key].dataType.simpleString() not in HASHED_TYPES for df in (left, right)):
        return exact_key_stats(left, right, key)
    k = F.col(key)
    sides = [
        df.select(F.lit(i == 1).alias("right"), F.when(k.isNotNull(), F.xxhash64(k)).alias("h"))
        for i, df in enumerate((left, right))
    ]
    per_hash = sides[0].unionAll(sides[1]).groupBy("right", "h").agg(F.count(F.lit(1)).alias("n"))
    with shuffles_freed(left.sparkSession):
        found = {
            row["right"]: KeyStats(row["rows"], row["no_key"], row["most"] > 1)
            for row in per_hash.groupBy("right")
            .agg(
                F.sum("n").alias("rows"),
                F.sum(F.when(F.col("h").isNull(), F.col("n")).otherwise(0)).alias("no_key"),
                F.max(F.when(F.col("h").isNotNull(), F.col("n")).otherwise(0)).alias("most"),
            )
            .collect()
        }
    stats = tuple(found.get(side, KeyStats(0, 0, False)) for side in (False, True))
    if stats[0].repeated or stats[1].repeated:
        return exact_key_stats(left, right, key)
    return stats


def exact_key_stats(left: DataFrame, right: DataFrame, key: str) -> tuple[KeyStats, KeyStats]:
    """The same by the keys themselves; one row reaches the driver."""
    return count_keys(left, right, key)[1]


def count_keys(
    left: DataFrame, right: DataFrame, key: str, **sums: Column
) -> tuple[dict[str, int], tuple[KeyStats, KeyStats]]:
    """``sums`` over the keys ``k`` of both tables, held by ``n0`` and ``n1`` rows (NULL is
    one of them), and both tables' statistics; one row reaches the driver."""
    sides = [
        df.select(
            F.col(key).alias("k"),
            F.lit(i == 0).cast("bigint").alias("n0"),
            F.lit(i == 1).cast("bigint").alias("n1"),
        )
        for i, df in enumerate((left, right))
    ]
    per_key = sides[0].unionAll(sides[1]).groupBy("k").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    has_key, zero = F.col("k").isNotNull(), F.lit(0).cast("bigint")
    total = per_key.agg(
        *[F.coalesce(value, zero).alias(name) for name, value in sums.items()],
        *[
            F.coalesce(value, zero).alias(f"_{name}{i}")
            for i in (0, 1)
            for n in [F.col(f"n{i}")]
            for name, value in (
                ("n", F.sum(n)),
                ("null", F.sum(F.when(~has_key, n))),
                ("most", F.max(F.when(has_key, n))),
            )
        ],
    )
    with shuffles_freed(left.sparkSession):
        found = total.first()
    stats = tuple(
        KeyStats(found[f"_n{i}"], found[f"_null{i}"], found[f"_most{i}"] > 1) for i in (0, 1)
    )
    return {name: found[name] for name in sums}, stats


def broadcast_small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcasting if its values, measured now, take 200 MB at most."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    # A row holds 8 bytes a column and as many again for its head; texts and decimals lie behind.
    fixed = 8 + sum(8 if f.dataType.simpleString() != "string" else 16 for f in df.schema.fields)
    fixed += 16 * sum(f.dataType.simpleString().startswith("decimal") for f in df.schema.fields)
    size = F.lit(fixed).cast("bigint")
    for c in texts:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    taken = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if taken <= BROADCAST_BYTES else df


@dataclass(frozen=True)
class Split:
    """Both sides cut into keys unique on each side, and the rest (if any)."""

    left: DataFrame
    right: DataFrame
    left_stats: KeyStats
    right_stats: KeyStats
    dup_left: DataFrame | None = None
    dup_right: DataFrame | None = None


def split_on_duplicates(
    left: DataFrame,
    right: DataFrame,
    key: str,
    probe_right: DataFrame | None = None,
    stats: tuple[KeyStats, KeyStats] | None = None,
) -> Split:
    """Separate the keys that are not unique; rows without a key stay in front.

    The test runs now (keys only).  Normally there are none, and the inputs come
    back as they are.  ``probe_right`` is a cheaper table known to hold the same
    duplicate keys as ``right``; the statistics are its.  ``stats`` that are known already are
    not taken again; the left ones may be of a table with more rows.
    """
    probe_right = right if probe_right is None else probe_right
    stats = stats or key_stats(left, probe_right, key)
    if not (stats[0].repeated or stats[1].repeated):
        return Split(left, right, *stats)
    dups = (
        duplicate_keys(left, key)
        .select(key)
        .unionByName(duplicate_keys(probe_right, key).select(key))
        .distinct()
    )
    dups = materialize(dups)

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(dups.withColumnRenamed(key, "_dup"), F.col(key) == F.col("_dup"), how)

    return Split(
        part(left, "left_anti"),
        part(right, "left_anti"),
        *stats,
        part(left, "left_semi"),
        part(right, "left_semi"),
    )


def key_blocks(
    left: DataFrame, right: DataFrame, key: str, stats: tuple[KeyStats, KeyStats]
) -> int:
    """Into how many blocks two tables with these statistics are cut by their keys, so that at
    most some ``ROWS_AT_ONCE`` rows of them are shuffled at a time."""
    kinds = {df.schema[key].dataType.simpleString() for df in (left, right)}
    if len(kinds) > 1 or not kinds <= set(HASHED_TYPES):
        return 1
    return max(1, math.ceil((stats[0].n + stats[1].n) / ROWS_AT_ONCE))


def in_block(df: DataFrame, key: str, i: int, n: int) -> DataFrame:
    """Rows of the ``i``-th of ``n`` blocks of keys; those without a key are in one of them."""
    return df if n == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def null_salt(key: str) -> Column:
    """0 for rows with a key; rows without one get their input partition's number.

    The 0 is computed, so the optimizer cannot drop the salt where it proves that
    there is a key: ``join_once`` needs the shuffle that comes with it.
    """
    partition = F.spark_partition_id()
    return F.when(F.col(key).isNull(), partition).otherwise(
        F.pmod(partition, F.lit(1))
    )


def outer_on_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join, rows aliased ``l`` and ``r`` with presence in ``_here``."""
    marked = F.lit(True).alias("_here")
    a = left.select("*", null_salt(key).alias("_salt"), marked).alias("l")
    b = right.select("*", null_salt(key).alias("_salt"), marked).alias("r")
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l._salt") == F.col("r._salt"))
    return a.join(b, on, "full_outer")


IN_LEFT, IN_RIGHT = "l._here", "r._here"
