"""Slowly changing dimensions, Type 2: every version of a row with its validity."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.config import VALID, Dimension
from lakestrata.functions.quality import valid_rows
from lakestrata.functions.scalar import changed, day, ts
from lakestrata.operators.keyed import (
    IN_LEFT,
    IN_RIGHT,
    outer_on_key,
    split_on_duplicates,
)
from lakestrata.operators.keys import assign_keys, highest, with_place
from lakestrata.operators.merge import OP, raise_on_duplicate_updates, single_versions
from lakestrata.operators.sets import (
    anti_not_in,
    mark_members,
    without_members,
)
from lakestrata.session import materialize

KEEP, CLOSE, INSERT, REOPEN = "keep", "close", "insert", "reopen"
VERSION_COLUMNS = ("eff_start_date", "eff_end_date", "is_current", "created_at", "updated_at")


@dataclass(frozen=True)
class Clock:
    """The one "now" of a run."""

    run_date: date
    run_ts: datetime

    @property
    def today(self) -> Column:
        return day(self.run_date)

    @property
    def now(self) -> Column:
        return ts(self.run_ts)


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def closed_rows(dim: DataFrame) -> DataFrame:
    """All but the current rows: also those of which it is not known."""
    return dim.where(~F.coalesce("is_current", F.lit(False)))


def scd2_actions(current: DataFrame, staged: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The change feed of a cycle: valid rows to upsert, and a delete marker, with
    NULL attributes, for each current key gone from staging."""
    upserts = valid_rows(staged).select(key, *columns, F.lit("UPSERT").alias("action"))
    gone = anti_not_in(current, staged, key).select(key, F.lit("DELETE").alias("action"))
    return upserts.unionByName(gone, allowMissingColumns=True)


def scd2_changes(
    current: DataFrame,
    staged: DataFrame,
    spec: Dimension,
    clock: Clock,
    compare: Sequence[str] | None = None,
    close_missing: bool = True,
    reopen: bool = True,
) -> DataFrame:
    """Every current row and every new version, with what happened in ``_op``.

    keep: untouched.  close: changed, or gone from staging.  insert: first version
    of a key without a current row.  reopen: new version of a changed key.  New
    versions have no surrogate key yet.  Closed history is not an input at all.

    One pass: current and staged rows meet in a single full outer join, and a
    changed row yields two.  Keys that are not unique take ``_literal_changes``.
    """
    compare = tuple(compare or spec.compare)
    split = split_on_duplicates(current, staged, spec.key)
    # A key is not missing while staging holds any row without a key, and no key
    # counts as free for a new version while a current row has none.
    blocked = F.lit(not close_missing or split.right_stats.n_null > 0)
    may_reopen = F.lit(reopen and split.left_stats.n_null == 0)

    here, there = F.col(IN_LEFT).isNotNull(), F.col(IN_RIGHT).isNotNull()
    good = there & (F.col("r.data_quality_flag") == VALID)
    differs = here & good & changed("l", "r", compare)
    gone = here & ~there & F.col(f"l.{spec.key}").isNotNull() & ~blocked
    # Tests get a projection of their own, or each column would carry a copy of them.
    joined = outer_on_key(split.left, split.right, spec.key).select(
        "*",
        here.alias("_old"),
        (differs | gone).alias("_closing"),
        ((good & ~here) | (differs & may_reopen)).alias("_starts"),
    )
    old, closing, starts = F.col("_old"), F.col("_closing"), F.col("_starts")

    kept = F.struct(
        *[_close(c, closing, clock) for c in current.columns],
        F.when(closing, CLOSE).otherwise(KEEP).alias(OP),
    )
    version = F.struct(
        *_new_version(current, spec, clock, "r."),
        F.when(old, REOPEN).otherwise(INSERT).alias(OP),
    )
    rows = F.array_compact(F.array(F.when(old, kept), F.when(starts, version)))
    out = joined.select(F.inline(rows))
    if split.dup_left is None:
        return out
    return out.unionByName(
        _literal_changes(
            split.dup_left, split.dup_right, spec, clock, compare, blocked, may_reopen
        )
    )


def _close(column: str, closing: Column, clock: Clock) -> Column:
    value = F.col(f"l.{column}")
    to = {
        "eff_end_date": F.date_sub(clock.today, 1),
        "is_current": F.lit(False),
        "updated_at": clock.now,
    }.get(column)
    return (F.when(closing, to).otherwise(value) if to is not None else value).alias(column)


def _new_version(current: DataFrame, spec: Dimension, clock: Clock, prefix: str) -> list[Column]:
    fixed = {
        spec.surrogate: F.lit(None),
        "eff_start_date": clock.today,
        "eff_end_date": F.lit(None),
        "is_current": F.lit(True),
        "created_at": clock.now,
        "updated_at": clock.now,
    }
    return [
        fixed.get(f.name, F.col(f"{prefix}{f.name}")).cast(f.dataType).alias(f.name)
        if f.name in fixed
        else F.col(f"{prefix}{f.name}").cast(f.dataType).alias(f.name)
        for f in current.schema.fields
    ]


def _literal_changes(
    current: DataFrame,
    staged: DataFrame,
    spec: Dimension,
    clock: Clock,
    compare: Sequence[str],
    blocked: Column,
    may_reopen: Column,
) -> DataFrame:
    """The same result as close-then-insert, for keys with several rows on a side.

    Closes are decided per distinct version of a row, not per pair of rows, and
    every row-level join is one that adaptive execution can split.
    """
    key = spec.key
    valid = valid_rows(staged)
    raise_on_duplicate_updates(current, valid, key, compare)
    versions = current.select(key, *compare).distinct()
    candidates = single_versions(valid, key, compare).select(key, *compare)
    outdated = (
        versions.alias("l")
        .join(
            candidates.alias("r"),
            (F.col(f"l.{key}") == F.col(f"r.{key}")) & changed("l", "r", compare),
            "left_semi",
        )
        .withColumn("_here", F.lit(True))
    )
    same = F.col(f"l.{key}") == F.col(f"r.{key}")
    for c in compare:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    closing = F.col(IN_RIGHT).isNotNull() | (F.col("_present").isNull() & ~blocked)
    kept = (
        mark_members(current, staged, key, "_present")
        .alias("l")
        .join(outdated.alias("r"), same, "left")
        .select(
            *[_close(c, closing, clock) for c in current.columns],
            F.when(closing, CLOSE).otherwise(KEEP).alias(OP),
        )
    )
    closed_out = without_members(valid, kept.where(F.col(OP) == KEEP), key)
    fresh = (
        mark_members(closed_out, current, key, "_old")
        .where(F.col("_old").isNull() | may_reopen)
        .select(
            *_new_version(current, spec, clock, ""),
            F.when(F.col("_old").isNull(), INSERT).otherwise(REOPEN).alias(OP),
        )
    )
    return kept.unionByName(fresh)


@dataclass(frozen=True)
class Scd2Result:
    """The pieces of the next state; closed history is left where it is."""

    current: DataFrame | None  # None where kept rows were not written
    newly_closed: DataFrame
    new_versions: DataFrame
    changes: DataFrame

    def table(self, history: DataFrame) -> DataFrame:
        return history.unionByName(self.newly_closed).unionByName(self.current)


def scd2_apply(
    current: DataFrame,
    staged: DataFrame,
    spec: Dimension,
    clock: Clock,
    start_key: int | None = None,
    order_by: Sequence[str] | None = None,
    path: str | None = None,
    kept: bool = True,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> Scd2Result:
    """Run a cycle and give new versions their surrogate keys.

    The changes are written once, split by kind, so kept, closed and new rows are
    each read from their own files.  Without ``kept`` only rows that differ are written;
    ``watch`` sees the rows as they are written.
    """
    if start_key is None:
        start_key = highest(current, spec.surrogate)
    changes = scd2_changes(current, staged, spec, clock, **options)
    if not kept:
        changes = changes.where(F.col(OP) != KEEP)
    if order_by:
        changes = with_place(changes)
    if watch:
        changes = watch(changes)
    changes = materialize(changes, partition_by=OP, path=path)
    fresh = changes.where(F.col(OP).isin(INSERT, REOPEN)).drop(OP, spec.surrogate)
    keyed = assign_keys(fresh, spec.surrogate, start_key, order_by)
    columns = current.columns
    stay = changes.where(F.col(OP) == KEEP).select(*columns)
    return Scd2Result(
        current=stay.unionByName(keyed.select(*columns)) if kept else None,
        newly_closed=changes.where(F.col(OP) == CLOSE).select(*columns),
        new_versions=keyed.select(*columns),
        changes=changes,
    )


def as_of(
    facts: DataFrame, dim: DataFrame, key: str, at: str, how: str = "inner"
) -> DataFrame:
    """Join each row to the dimension versions valid on its date ``at``.

    Versions are put into the periods they touch and rows into the period of their date, so a
    row meets a version only if both fall into one period of the key.  A period is as long as
    the versions are on average, cut to the rows' dates: a version then has two entries on
    average, and a key of very many versions no more candidates for a row than begin in a period.
    A version whose range is empty (closed on the day it began) is never valid.
    """
    span = facts.agg(F.to_date(F.min(at)).alias("lo"), F.to_date(F.max(at)).alias("hi")).first()
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    first, last = F.greatest("eff_start_date", lo), F.least(F.coalesce("eff_end_date", hi), hi)
    held = (
        dim.where("eff_start_date is not null")
        .withColumn("_from", F.datediff(first, lo))
        .withColumn("_to", F.datediff(last, lo))
        .where("_from <= _to")
    )
    mean = held.agg(F.avg(F.col("_to") - F.col("_from") + 1)).first()[0]
    days = F.lit(max(1, math.ceil(mean or 1)))
    slots = F.sequence(F.floor(F.col("_from") / days), F.floor(F.col("_to") / days))
    d = held.withColumn("_slot", F.explode(slots)).drop("_from", "_to").alias("d")
    f = facts.withColumn("_at", F.floor(F.datediff(at, lo) / days)).alias("f")
    on = (
        (F.col(f"f.{key}") == F.col(f"d.{key}"))
        & (F.col("f._at") == F.col("d._slot"))
        & (F.col("d.eff_start_date") <= F.col(f"f.{at}"))
        & (F.col("d.eff_end_date").isNull() | (F.col(f"f.{at}") <= F.col("d.eff_end_date")))
    )
    columns = [F.col(f"f.{c}") for c in facts.columns]
    return f.join(d, on, how).select(*columns, *[F.col(f"d.{c}") for c in dim.columns if c != key])


def shift_closed_end(dim: DataFrame, days: int = 1) -> DataFrame:
    """Backfill: move the end of closed versions back."""
    moved = F.when(
        ~F.col("is_current") & F.col("eff_end_date").isNotNull(),
        F.date_sub("eff_end_date", days),
    ).otherwise(F.col("eff_end_date"))
    return dim.withColumn("eff_end_date", moved)


def reset_current_start(dim: DataFrame, run_date: date) -> DataFrame:
    """Backfill: current versions begin on the run date."""
    start = F.when(F.col("is_current"), day(run_date)).otherwise(F.col("eff_start_date"))
    return dim.withColumn("eff_start_date", start)
