"""Operators against a literal, row-by-row reading of the statements they stand for."""

import random
import time
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata import session
from lakestrata.config import Dimension, Fact, Lookup
from lakestrata.functions import scalar
from lakestrata.functions.quality import valid_rows
from lakestrata.operators import audit, checks, dedupe, fact, keyed, keys, merge, scd2, sets
from lakestrata.operators.keyed import DuplicateKeyError
from lakestrata.plans.music import ALBUMS, SONGS, STEPS
from lakestrata.plans.staging import stage_delta, stage_full
from registry import queries

CLOCK = scd2.Clock(date(2024, 2, 2), datetime(2024, 2, 2))
SPEC = Dimension("d", "k", "sk", ("a", "b"), ("a", "b"), ("a",))
SONG = Fact("f", "k", "sk", (), ("a", "b"), ("a", "b"), ("a",), ("a",))
STAGED = "k string, a string, b string, data_quality_flag string"
DIM = (
    "sk bigint, k string, a string, b string, eff_start_date date, eff_end_date date,"
    " is_current boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
)
FACT = "sk bigint, k string, a string, b string, _load_timestamp timestamp_ntz, is_valid boolean"
OLD = datetime(2024, 1, 1)


def differs(x, y):
    """NULL on either side is no difference."""
    return any(p is not None and q is not None and p != q for p, q in zip(x, y))


def not_in(value, others):
    """Three-valued, as a filter sees it."""
    if not others:
        return True
    if value is None or None in others:
        return False
    return value not in others


def make_rows(rng, n, keys_, null_keys, valid=0.8):
    out = []
    for _ in range(n):
        key = None if null_keys and rng.random() < 0.1 else f"k{rng.randrange(keys_)}"
        a, b = (rng.choice(["x", "y", None]) for _ in range(2))
        out.append((key, a, b, "VALID" if rng.random() < valid else "BAD"))
    return out


def unique(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is None or r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


# -- merge ----------------------------------------------------------------------


def literal_merge(target, source, compare, delete):
    """Rows (k, a, b); raises on several updates of one row."""
    out = Counter()
    tkeys = {t[0] for t in target if t[0] is not None}
    for t in target:
        same = [s for s in source if t[0] is not None and s[0] == t[0]]
        hits = [s for s in same if not compare or differs(s[1:], t[1:])]
        if len(hits) > 1:
            raise DuplicateKeyError
        if hits:
            out[(*hits[0], "update")] += 1
        elif delete and source and not_in(t[0], [s[0] for s in source]) and not same:
            out[(*t, "delete")] += 1
        else:
            out[(*t, "keep")] += 1
    for s in source:
        if s[0] not in tkeys:
            out[(*s, "insert")] += 1
    return out


@pytest.mark.parametrize("seed", range(6))
def test_merge_is_the_literal_merge(spark, seed):
    rng = random.Random(seed)
    null_keys, compare = seed % 2 == 0, seed % 3 == 0
    target = [r[:3] for r in make_rows(rng, 40, 30, null_keys)]
    source = [r[:3] for r in make_rows(rng, 30, 45, null_keys)]
    if seed < 4:
        # No duplicate source row may meet a target row, but new keys may repeat.
        source = unique(source) + [("new", "x", "y"), ("new", "x", "y"), ("new", None, "z")]
    schema = "k string, a string, b string"
    call = dict(compare=("a", "b") if compare else None, delete_missing=True)
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    try:
        want = literal_merge(target, source, compare, True)
    except DuplicateKeyError:
        with pytest.raises(DuplicateKeyError):
            merge.merge(t, s, "k", **call)
        return
    got = merge.merge(t, s, "k", **call)
    assert Counter(tuple(r) for r in got.select("k", "a", "b", "_op").collect()) == want
    again = merge.merge(merge.state(got).where("k is not null"), s.where("k <> 'new'"), "k")
    assert again.where("_op = 'insert' and k is not null").count() == 0


def test_empty_snapshot_deletes_nothing(spark):
    schema = "k string, a string"
    t = spark.createDataFrame([("k1", "x"), (None, "y")], schema)
    none = spark.createDataFrame([], schema)
    assert sets.guarded_delete(t, none, "k").count() == 2
    assert merge.state(merge.merge(t, none, "k", delete_missing=True)).count() == 2


@pytest.mark.parametrize("right", [[], ["k1"], ["k1", None], [None]])
def test_not_in(spark, right):
    left = ["k1", "k2", None]
    l_df = spark.createDataFrame([(x,) for x in left], "k string")
    r_df = spark.createDataFrame([(x,) for x in right], "k string")
    got = {r["k"] for r in sets.anti_not_in(l_df, r_df, "k").collect()}
    assert got == {x for x in left if not_in(x, right)}


def test_not_in_plan_does_not_broadcast_the_right_side(spark):
    big = spark.range(1000).selectExpr("cast(id as string) k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sets.anti_not_in(big, big, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


# -- dimensions -------------------------------------------------------------------


def literal_scd2(current, staged, missing=True, reopen=True):
    """Close by merge, then insert what has no current row; rows (k, a, b, op)."""
    valid = [s for s in staged if s[3] == "VALID"]
    staged_keys = [s[0] for s in staged]
    out, still = Counter(), []
    for c in current:
        hits = [s for s in valid if s[0] == c[0] and differs(s[1:3], c[1:3])]
        if len(hits) > 1:
            raise DuplicateKeyError
        gone = missing and not_in(c[0], staged_keys)
        if hits or gone:
            out[(*c, "close")] += 1
        else:
            out[(*c, "keep")] += 1
            still.append(c[0])
    before = {c[0] for c in current}
    for s in valid:
        if s[0] not in before:
            out[(*s[:3], "new")] += 1
        elif reopen and not_in(s[0], still):
            out[(*s[:3], "new")] += 1
    return out


@pytest.mark.parametrize("seed", range(10))
def test_scd2_is_the_literal_two_statements(spark, seed):
    rng = random.Random(100 + seed)
    staged = make_rows(rng, 40, 40, null_keys=False)
    held = [r[:3] for r in make_rows(rng, 25, 40, null_keys=False)]
    if seed < 3:
        staged, held = unique(staged), unique(held)
    elif seed < 7:
        # Copies in staging of rows unlike anything current, and duplicate current rows.
        staged = unique(staged) + [("n1", "x", "y", "VALID")] * 3
        staged += [(*held[0][:3], "VALID"), (*held[0][:3], "VALID")]
    if seed % 2:
        staged.append((None, "x", "y", "BAD"))
    if seed == 4:
        held.append((None, "x", "y"))
    if seed == 2:
        staged = []
    current = [
        (i + 1, *h, date(2024, 1, 1), None, True, OLD, OLD) for i, h in enumerate(held)
    ]
    dim, stg = spark.createDataFrame(current, DIM), spark.createDataFrame(staged, STAGED)
    try:
        want = literal_scd2(held, staged)
    except DuplicateKeyError:
        with pytest.raises(DuplicateKeyError):
            scd2.scd2_apply(dim, stg, SPEC, CLOCK)
        return
    result = scd2.scd2_apply(dim, stg, SPEC, CLOCK, order_by=["k"])
    got = Counter()
    for r in result.changes.collect():
        op = "new" if r["_op"] in ("insert", "reopen") else r["_op"]
        got[(r["k"], r["a"], r["b"], op)] += 1
    assert got == want
    table = result.table(scd2.closed_rows(dim)).collect()
    assert len({r["sk"] for r in table}) == len(table)
    fresh = sorted(r["sk"] for r in table if r["eff_start_date"] == CLOCK.run_date)
    assert fresh == list(range(len(held) + 1, len(held) + 1 + len(fresh)))
    for r in table:
        closed = not r["is_current"]
        assert r["eff_end_date"] == (date(2024, 2, 1) if closed else None)


def test_scd2_chain_keeps_one_current_row_and_no_overlap(spark):
    rng = random.Random(7)
    dim = spark.createDataFrame([], DIM)
    for day in range(1, 5):
        clock = scd2.Clock(date(2024, 3, day), datetime(2024, 3, day))
        staged = spark.createDataFrame(unique(make_rows(rng, 60, 40, False)), STAGED)
        result = scd2.scd2_apply(
            scd2.current_rows(dim), staged, SPEC, clock, start_key=keys.highest(dim, "sk")
        )
        dim = result.table(scd2.closed_rows(dim))
    assert checks.duplicates(scd2.current_rows(dim), "k").count() == 0
    assert checks.overlaps(dim, "k", "sk").count() == 0
    assert dim.count() == dim.select("sk").distinct().count()


def test_two_changes_on_one_day_leave_an_empty_range(spark):
    dim = spark.createDataFrame([], DIM)
    for name in ("x", "y"):
        staged = spark.createDataFrame([("k", name, None, "VALID")], STAGED)
        dim = scd2.scd2_apply(dim, staged, SPEC, CLOCK).table(scd2.closed_rows(dim))
    old = scd2.closed_rows(dim).first()
    assert old["eff_end_date"] < old["eff_start_date"]
    asked = spark.createDataFrame([("k", CLOCK.run_date)], "k string, day date")
    assert [r["a"] for r in scd2.as_of(asked, dim, "k", "day").collect()] == ["y"]


# -- fact ---------------------------------------------------------------------------


def literal_fact(held, staged):
    """Merge changed, insert new, then soft delete and re-validate; (k, a, b, valid)."""
    valid = [s for s in staged if s[3] == "VALID"]
    out, known = [], {h[0] for h in held}
    for h in held:
        hits = [s for s in valid if s[0] == h[0] and differs(s[1:3], h[1:3])]
        if len(hits) > 1:
            raise DuplicateKeyError
        out.append((h[0], *(hits[0][1:3] if hits else h[1:3]), h[3]))
    out += [(*s[:3], True) for s in valid if s[0] not in known]
    every, good = [s[0] for s in staged], {s[0] for s in valid}
    out = [(*r[:3], False if r[3] and not_in(r[0], every) else r[3]) for r in out]
    return Counter((*r[:3], True if not r[3] and r[0] in good else r[3]) for r in out)


@pytest.mark.parametrize("seed", range(8))
def test_fact_cycle_is_the_literal_statements(spark, seed):
    rng = random.Random(200 + seed)
    staged = make_rows(rng, 40, 40, null_keys=False)
    held = [(*r[:3], rng.random() < 0.7) for r in make_rows(rng, 30, 40, False)]
    if seed < 6:
        staged = unique(staged) + [("n1", "x", "y", "VALID")] * 2 + [("k1", "x", "x", "BAD")]
    if seed % 3 == 0:
        staged.append((None, "x", "y", "BAD"))
    if seed == 5:
        staged = []
    table = [(i + 1, *h[:3], OLD, h[3]) for i, h in enumerate(held)]
    facts, stg = spark.createDataFrame(table, FACT), spark.createDataFrame(staged, STAGED)
    try:
        want = literal_fact(held, staged)
    except DuplicateKeyError:
        with pytest.raises(DuplicateKeyError):
            fact.fact_apply(facts, stg, {}, SONG, CLOCK)
        return
    got = fact.fact_apply(facts, stg, {}, SONG, CLOCK, order_by=["k"]).table
    assert Counter(tuple(r) for r in got.select("k", "a", "b", "is_valid").collect()) == want
    assert got.select("sk").distinct().count() == got.count()


def test_soft_delete_shuffles_the_keys_once(spark):
    """Counting the staged keys takes the shuffles that the join makes of them."""
    rows = [(f"k{i % 40}", i) for i in range(80)]
    staged = spark.createDataFrame(rows, "k string, n int").groupBy("k").agg(F.max("n").alias("n"))
    facts = spark.createDataFrame([("k1", True), ("x", True), (None, True)], "k string, is_valid boolean")
    got = fact.soft_delete(facts, staged.select("k"), "k")
    assert {r.k: r.is_valid for r in got.collect()} == {"k1": True, "x": False, None: True}
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_unread_lookups_go_unless_they_repeat_rows(spark):
    once = [(1, "a", True), (2, "b", True), (3, "b", False), (4, None, True), (5, None, True)]
    twice = [*once, (6, "a", True)]
    spec = replace(SONG, lookups=(Lookup(SPEC),), attributes=("sk", "a"))
    for rows, read, kept in ((once, [], 0), (once, ["sk"], 1), (twice, [], 1), ([], [], 0)):
        dims = {SPEC.table: spark.createDataFrame(rows, "sk bigint, k string, is_current boolean")}
        got = fact.without_unread(spec, dims, read)
        assert len(got.lookups) == kept and got.attributes == (("sk", "a") if kept else ("a",))


def test_songs_without_surrogate_keys_join_nothing(spark):
    """The same songs, also where a dimension holds a natural key twice."""
    data = queries.Data(spark, "/root/testdata/sf0.001")
    dims = data.dims()
    more = dims["dim_albums"].union(dims["dim_albums"].limit(5))
    for albums, joins in ((dims["dim_albums"], 0), (more, 1)):
        some = {**dims, "dim_albums": albums}
        got = data.songs(some, read=())
        want = data.songs(some).drop("artist_sk", "album_sk")
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == joins


def test_soft_delete_and_revalidate_alone(spark):
    held = [("k1", "x", "y", True), ("k2", "x", "y", True), ("k3", "x", "y", False)]
    facts = spark.createDataFrame(
        [(i, *h[:3], OLD, h[3]) for i, h in enumerate(held)], FACT
    )

    def after(df):
        return {r["k"]: r["is_valid"] for r in df.collect()}

    staged = [("k1", "x", "y", "BAD"), ("k3", "x", "y", "VALID")]
    some = spark.createDataFrame(staged, STAGED)
    assert after(fact.soft_delete(facts, some, "k")) == {"k1": True, "k2": False, "k3": False}
    assert after(fact.revalidate(facts, some, "k")) == {"k1": True, "k2": True, "k3": True}
    blocked = spark.createDataFrame([*staged, (None, "x", "y", "BAD")], STAGED)
    assert after(fact.soft_delete(facts, blocked, "k"))["k2"] is True
    none = spark.createDataFrame([], STAGED)
    assert after(fact.soft_delete(facts, none, "k")) == {"k1": False, "k2": False, "k3": False}


def test_fan_out_of_a_lookup_is_a_duplicate(spark):
    """Two current rows of one artist double the song, which then hits the merge."""
    from lakestrata.config import Lookup

    spec = Dimension("d", "dk", "d_sk", (), (), ())
    song = Fact("f", "k", "sk", (Lookup(spec),), ("d_sk", "a"), ("d_sk", "a"), (), ())
    dims = {"dim_d": spark.createDataFrame(
        [(1, "d1", True), (2, "d1", True), (3, "d2", False)],
        "d_sk bigint, dk string, is_current boolean")}
    staged = spark.createDataFrame(
        [("k1", "x", "d1", "VALID"), ("k2", "x", "d2", "VALID"), ("k3", "x", None, "VALID")],
        "k string, a string, dk string, data_quality_flag string")
    empty = spark.createDataFrame(
        [], "sk bigint, k string, d_sk bigint, a string, is_valid boolean")
    first = fact.fact_apply(empty, staged, dims, song, CLOCK, order_by=["k"]).table
    got = sorted((r["k"], r["d_sk"] or 0) for r in first.collect())
    assert got == [("k1", 1), ("k1", 2), ("k2", 0), ("k3", 0)]
    other = staged.withColumn("a", F.lit("y"))
    with pytest.raises(DuplicateKeyError):
        fact.fact_apply(first, other, dims, song, CLOCK)


# -- keys, clean-up -------------------------------------------------------------------


def test_keys_are_dense_and_ordered_with_a_hot_key(spark):
    df = spark.range(9000).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end k", "id % 50 v"
    )
    got = keys.assign_keys(df, "sk", 100, ["k"]).collect()
    assert sorted(r["sk"] for r in got) == list(range(101, 9101))
    ordered = [r["k"] for r in sorted(got, key=lambda r: r["sk"])]
    assert ordered == sorted(ordered)
    plain = keys.assign_keys(df, "sk").collect()
    assert sorted(r["sk"] for r in plain) == list(range(1, 9001))
    assert Counter((r["k"], r["v"]) for r in plain) == Counter((r["k"], r["v"]) for r in got)


def test_equal_rows_spread_over_ranges(spark, small_partitions):
    """A third of the rows are copies of one row; no single range takes them all."""
    df = spark.range(0, 30_000, 1, 8).selectExpr(HOT)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keys.assign_keys(df, "sk", 0, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.select("sk").distinct().count() == 30_000
    hot = got.where("k = 'hot'")
    span = hot.agg(F.min("sk"), F.max("sk"), F.count("sk")).first()
    assert span[1] - span[0] + 1 == span[2] == 10_000
    assert hot.select(F.col("_metadata.file_path").alias("f")).distinct().count() > 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_as_of_matches_all_pairs_and_meets_few(spark, how):
    """A key of very many versions: rows meet those of their period only."""
    rng = random.Random(4)
    day0 = date(2000, 1, 1)
    versions = [("hot", i, day0 + timedelta(days=i), day0 + timedelta(days=i)) for i in range(3000)]
    for i in range(200):
        start = day0 + timedelta(days=rng.randrange(3000))
        end = None if i % 5 == 0 else start + timedelta(days=rng.randrange(-1, 900))
        versions.append((f"k{i % 40}", 10_000 + i, start, end))
    versions += [("hot", 20_000, None, None), (None, 20_001, day0, None)]
    facts = [(i, "hot" if i % 2 else f"k{rng.randrange(45)}", day0 + timedelta(days=rng.randrange(-20, 3100)))
             for i in range(2000)] + [(5000, "hot", None), (5001, None, day0)]
    dim = spark.createDataFrame(versions, "k string, v int, eff_start_date date, eff_end_date date")
    asked = spark.createDataFrame(facts, "n int, k string, day date")
    got = scd2.as_of(asked, dim, "k", "day", how)
    want = []
    for n, k, at in facts:
        hits = [v for key, v, a, e in versions
                if key == k and k and at and a and a <= at and (e is None or at <= e)]
        want += [(n, v) for v in hits] or ([(n, None)] if how == "left" else [])
    assert sorted(map(str, ((r["n"], r["v"]) for r in got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_at" in plan and "_slot" in plan  # the period is part of the join's equality
    assert scd2.as_of(asked.limit(0), dim, "k", "day").count() == 0
    assert scd2.as_of(asked, dim.limit(0), "k", "day", "left").count() == len(facts)


def test_overlaps_match_a_plain_window(spark):
    from pyspark.sql.window import Window

    rng = random.Random(3)
    rows = []
    for i in range(400):
        start = date(2024, 1, rng.randrange(1, 28))
        end = None if rng.random() < 0.2 else date(2024, 1, rng.randrange(1, 31))
        rows.append((i, f"k{rng.randrange(40)}" if i % 3 else "hot", start, end))
    dim = spark.createDataFrame(
        rows, "sk bigint, k string, eff_start_date date, eff_end_date date"
    )
    w = Window.partitionBy("k").orderBy("eff_start_date", "sk")
    real = dim.where("eff_end_date is null or eff_start_date <= eff_end_date")
    want = real.withColumn("nxt", F.lead("eff_start_date").over(w)).where(
        "nxt is not null and (eff_end_date is null or eff_end_date >= nxt)"
    )
    got = checks.overlaps(dim, "k", "sk")
    assert {(r["sk"], r["next_start_date"]) for r in got.collect()} == {
        (r["sk"], r["nxt"]) for r in want.collect()
    }


def test_keep_latest_leaves_history_alone(spark):
    dim = spark.createDataFrame(
        [(1, "a", False), (2, "a", True), (3, "a", True), (4, None, True), (5, None, True)],
        "sk bigint, k string, is_current boolean",
    )
    kept = {r["sk"] for r in dedupe.keep_latest_current(dim, "k", "sk").collect()}
    assert kept == {1, 3, 5}


# -- types and flags --------------------------------------------------------------------


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_numbers(spark):
    df = texts(spark, "3.7", " 12 ", "1e3", "", "abc", "0.5", "-0.5", None, "9" * 38)
    got = [r[0] for r in df.select(scalar.try_number("x").cast("string")).collect()]
    assert got == ["4", "12", "1000", None, None, "1", "-1", None, "9" * 38]


def test_durations(spark):
    millis = (0, 119_700, 59_499, 59_500, 60_000, 3_600_000)
    df = spark.createDataFrame([(m,) for m in millis], "m bigint").select(
        F.col("m").cast("decimal(38,0)").alias("m")
    )
    text = scalar.duration_text(scalar.whole_minutes("m"), scalar.leftover_seconds("m"))
    got = [r[0] for r in df.select(text).collect()]
    assert got == ["0:00", "1:60", "0:59", "0:60", "1:00", "60:00"]


def test_timestamps_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = texts(
        spark,
        "2026-03-29 02:30:00",
        "2026-07-14T09:19:46Z",
        "2026-07-14T09:19:46.5",
        "2026-07-14",
        "14.07.2026",
        None,
    )
    try:
        for name in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = [r[0] for r in df.select(scalar.try_timestamp_auto("x")).collect()]
            assert got == [
                datetime(2026, 3, 29, 2, 30),
                datetime(2026, 7, 14, 9, 19, 46),
                datetime(2026, 7, 14, 9, 19, 46, 500_000),
                datetime(2026, 7, 14),
                None,
                None,
            ]
            seconds = df.limit(1).select(
                scalar.seconds_between(
                    scalar.ts("2026-03-29 01:59:59.9"), scalar.ts("2026-03-29 03:00:01.1")
                )
            )
            assert seconds.first()[0] == 3602
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def raw_row(spark, entity, **values):
    row = {c: "1" for c in entity.columns} | values
    schema = T.StructType(
        [*entity.text_schema.fields, T.StructField("_load_timestamp", T.TimestampNTZType())]
    )
    return spark.createDataFrame([(*[row[c] for c in entity.columns], OLD)], schema)


def flag(df):
    return df.first()["data_quality_flag"]


def test_full_and_delta_rules_differ_as_they_should(spark):
    song = raw_row(spark, SONGS, song_added="bad", album_id=None)
    assert flag(stage_full(song, SONGS, OLD)) == "INVALID_DATE"
    assert flag(stage_delta(song, SONGS, OLD)) == "VALID"
    album = raw_row(spark, ALBUMS, album_release_date="07/14/2026")
    full, delta = stage_full(album, ALBUMS, OLD).first(), stage_delta(album, ALBUMS, OLD).first()
    assert (full["data_quality_flag"], full["album_release_date"]) == ("VALID", None)
    assert delta["album_release_date"] == date(2026, 7, 14)
    bad = raw_row(spark, ALBUMS, album_release_date="2020-13-01")
    assert flag(stage_full(bad, ALBUMS, OLD)) == "INVALID_DATE"
    assert flag(stage_delta(bad, ALBUMS, OLD)) == "INVALID_RELEASE_DATE"


def test_rules_see_untrimmed_text(spark):
    song = raw_row(spark, SONGS, song_id="  ", song_added="2024-01-01 00:00:00")
    row = stage_full(song, SONGS, OLD).first()
    assert (row["song_id"], row["data_quality_flag"]) == ("", "VALID")


# -- skew ---------------------------------------------------------------------------------


@pytest.fixture
def small_partitions(spark):
    """Thresholds so low that a hot key of a test table counts as skew."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def partition_sizes(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect())


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


HOT = "case when id % 3 = 0 then 'hot' else cast(id as string) end k"


@pytest.mark.parametrize("how", ["semi", "anti", "guard", "mark"])
def test_hot_left_key_is_split(spark, small_partitions, how):
    left = spark.range(0, 30_000, 1, 8).selectExpr(HOT, "sha2(cast(id as string), 256) v")
    right = spark.range(0, 30_000, 2, 4).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end k"
    )
    df = {
        "semi": sets.semi_in,
        "anti": lambda a, b, k: sets.anti_not_in(a, b.where("k <> 'hot'"), k),
        "guard": sets.guarded_delete,
        "mark": lambda a, b, k: sets.mark_members(a, b, k, "m"),
    }[how](left, right, "k")
    assert "skew=true" in executed(df)
    ids = range(30_000)
    hit = sum(1 for i in ids if i % 3 == 0 or i % 2 == 0)
    n = {"semi": hit, "anti": 30_000 - hit + 10_000, "guard": hit, "mark": 30_000}[how]
    assert df.count() == n


def test_rows_without_a_key_are_spread(spark, small_partitions):
    """A third of both sides has no key: no task of the join gets them all."""
    rows = "case when id % 3 = 0 then null else cast(id as string) end k"
    t = spark.range(0, 30_000, 1, 64).selectExpr(rows, "id v")
    s = spark.range(1, 30_001, 1, 64).selectExpr(rows, "id + 1 v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = merge.merge(t, s, "k")
        sizes = partition_sizes(out)
        assert sum(sizes) == out.count() == 30_000 - 10_000 + 20_000
        assert max(sizes) < 8_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_merge_with_a_hot_new_key_and_a_hot_old_key(spark):
    """A third of the source is one new key, a third of the target is one old key."""
    t = spark.range(9_000).selectExpr(
        "case when id % 3 = 0 then 'old' else cast(id as string) end k", "'x' a"
    )
    s = spark.range(9_000).selectExpr(
        "case when id % 3 = 0 then 'new' else concat('s', id) end k", "'y' a"
    ).unionByName(spark.createDataFrame([("old", "y"), ("1", "y")], "k string, a string"))
    counts = {r["_op"]: r["n"] for r in merge.change_counts(merge.merge(t, s, "k")).collect()}
    assert counts == {"insert": 9_000, "update": 3_001, "keep": 5_999}
    counts = {
        r["_op"]: r["n"]
        for r in merge.change_counts(merge.merge(t, s, "k", compare=["a"])).collect()
    }
    assert counts == {"insert": 9_000, "update": 3_001, "keep": 5_999}


def test_scd2_two_staged_rows_one_of_them_new(spark):
    """Closed by the one that differs, then both come in: two current rows."""
    dim = spark.createDataFrame(
        [(1, "k", "x", None, date(2024, 1, 1), None, True, OLD, OLD)], DIM
    )
    staged = spark.createDataFrame(
        [("k", "x", None, "VALID"), ("k", "y", None, "VALID")], STAGED
    )
    after = scd2.scd2_apply(dim, staged, SPEC, CLOCK).table(scd2.closed_rows(dim))
    got = sorted((r["a"], r["is_current"]) for r in after.collect())
    assert got == [("x", False), ("x", True), ("y", True)]
    assert checks.duplicates(scd2.current_rows(after), "k").count() == 1


def test_first_load_into_an_empty_table_moves_no_rows(spark):
    """All rows are new: nothing to count by key, to join or to refuse, repeated keys included."""
    rows = [("a", "x", None, "VALID"), ("a", "y", "1", "VALID"), (None, "z", "2", "VALID")]
    staged = spark.createDataFrame([*rows, ("b", "x", "3", "BAD")], STAGED).withColumn(
        "_load_timestamp", F.lit(OLD)
    )
    empty = spark.createDataFrame([], FACT)
    changes = fact.initial_changes(empty, staged, {}, SONG, CLOCK)
    assert "Join" not in plan(changes) and "Exchange" not in plan(changes)
    got = changes.select("sk", "k", "a", "b", "is_valid", "_op").collect()
    assert Counter(map(tuple, got)) == Counter(
        (None, k, a, b, True, merge.INSERT) for k, a, b, _ in rows
    )
    table = fact.fact_initial(empty, staged, {}, SONG, CLOCK, order_by=["k"]).table
    assert sorted(r["sk"] for r in table.collect()) == [1, 2, 3]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_valid_rows_test_parsed_values_not_texts(spark):
    """The test stays above the parsing, so that no text is parsed for it a second time."""
    raw = spark.range(4).selectExpr("cast(id as string) t")
    staged = raw.withColumn("n", F.regexp_extract("t", "(.)", 1)).withColumn(
        "data_quality_flag", F.when(F.col("n") == "2", "BAD").otherwise("VALID")
    )
    kept = valid_rows(staged).select("n")
    assert sorted(r["n"] for r in kept.collect()) == ["0", "1", "3"]
    tests = [line for line in plan(kept).splitlines() if "Filter" in line]
    assert tests and not any("regexp_extract" in line for line in tests)


def test_key_stats_by_hash(spark):
    """Hashes are shuffled, not keys; what they cannot settle is counted by the keys."""
    left = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), ("c",)], "k string")
    unique = right.distinct()
    assert keyed.key_stats(left, unique, "k") == (
        keyed.KeyStats(4, 2, False),
        keyed.KeyStats(2, 0, False),
    )
    assert keyed.key_stats(left, right, "k") == keyed.exact_key_stats(left, right, "k")
    assert keyed.key_stats(left.limit(0), right.limit(0), "k")[0] == keyed.KeyStats(0, 0, False)
    halves = spark.createDataFrame([(0.0,), (-0.0,)], "k double")
    assert keyed.key_stats(halves, halves, "k")[0].repeated


def test_a_small_dimension_is_broadcast_by_its_measured_size(spark, monkeypatch):
    facts = spark.range(10).selectExpr("id", "cast(id as string) n")
    dim = spark.range(10).selectExpr("cast(id as string) nk", "id sk")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = facts.join(keyed.broadcast_small(dim), F.col("n") == F.col("nk"), "left")
        assert "BroadcastHashJoin" in plan(small)
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", 100)
        large = facts.join(keyed.broadcast_small(dim), F.col("n") == F.col("nk"), "left")
        assert "BroadcastHashJoin" not in plan(large)
        assert sorted(small.collect()) == sorted(large.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("null_keys", [False, True])
def test_merge_of_a_snapshot_moves_only_keys_of_the_target(spark, null_keys):
    """Nothing of a target row with a key is left: its values are not even computed."""
    t = spark.createDataFrame([("k1", "y"), ("k2", "z")], "k string, a string")
    if null_keys:
        t = t.unionByName(spark.createDataFrame([(None, "n")], t.schema))
    t = t.withColumn("a", F.concat("a", F.sha1("k").substr(1, 0)))
    s = spark.createDataFrame([("k1", "new"), ("k3", "new")], "k string, a string")
    call = dict(delete_missing=True, whole_deletes=False)
    changes = merge.merge(t, s, "k", **call)
    assert ("sha1" in plan(merge.state(changes))) == null_keys
    assert sorted(map(tuple, merge.state(changes).fillna("-").collect())) == sorted(
        map(tuple, merge.state(merge.merge(t, s, "k", delete_missing=True)).fillna("-").collect())
    )
    ops = Counter(r["_op"] for r in changes.collect())
    assert ops == Counter(["update", "insert", "delete", *["keep"] * null_keys])
    # A source without keys deletes nothing, so target rows stay whole.
    open_end = s.unionByName(spark.createDataFrame([(None, "new")], s.schema))
    kept = merge.state(merge.merge(t, open_end, "k", **call)).where("k = 'k2'").collect()
    assert [r["a"] for r in kept] == ["z"]


@pytest.mark.parametrize("seed", range(6))
def test_snapshot_counts_are_those_of_the_merge(spark, seed):
    rng = random.Random(seed)
    target = [r[:3] for r in make_rows(rng, 40, 30, seed % 2 == 0)]
    source = [r[:3] for r in make_rows(rng, 30, 45, seed % 3 == 0)]
    if seed < 4:
        source = unique(source) + [("new", "x", "y"), ("new", "x", "y")]
    schema = "k string, a string, b string"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    try:
        want = Counter(c[-1] for c in literal_merge(target, source, False, True).elements())
    except DuplicateKeyError:
        with pytest.raises(DuplicateKeyError):
            merge.snapshot_counts(t, s, "k")
        return
    counts, stats = merge.snapshot_counts(t, s, "k")
    assert Counter(counts) == want and stats == keyed.exact_key_stats(t, s, "k")
    none = merge.snapshot_counts(t, s.limit(0), "k")[0]
    assert none == {"insert": 0, "update": 0, "delete": 0, "keep": len(target)}


def test_fact_changes_take_known_key_statistics(spark, monkeypatch):
    rows = [("a", "x", "1", "VALID"), ("b", "y", "2", "VALID")]
    staged = spark.createDataFrame(rows, STAGED).withColumn("_load_timestamp", F.lit(OLD))
    table = fact.fact_initial(
        spark.createDataFrame([], FACT), staged, {}, SONG, CLOCK, order_by=["k"]
    ).table
    later = staged.where("k = 'a'")
    want = sorted(map(str, fact.fact_changes(table, later, {}, SONG, CLOCK).collect()))
    known = keyed.key_stats(table, later, "k")
    monkeypatch.setattr(keyed, "key_stats", None)
    got = fact.fact_changes(table, later, {}, SONG, CLOCK, stats=known)
    assert sorted(map(str, got.collect())) == want


@pytest.fixture
def few_rows_at_once(monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_AT_ONCE", 20)


@pytest.mark.parametrize("seed", range(8))
def test_fact_cycle_in_blocks_is_the_literal_statements(spark, seed, few_rows_at_once):
    """Each block of keys by itself, with the key statistics of all."""
    test_fact_cycle_is_the_literal_statements(spark, seed)


def test_fact_cycle_shuffles_a_block_of_keys_at_a_time(spark, few_rows_at_once):
    """Fact rows and staged rows in blocks that hold each row once, written one by one."""
    table = [(i, f"k{i}", "x", None, OLD, True) for i in range(40)]
    facts = spark.createDataFrame([*table, (99, None, "x", None, OLD, True)], FACT)
    staged = spark.createDataFrame([(f"k{i}", "y", None, "VALID") for i in range(20, 60)], STAGED)
    for stored in (True, False):
        blocks = fact.fact_blocks(facts, staged, {}, SONG, CLOCK, stored=stored)
        assert len(blocks) == 5
        assert all(0 < b.count() < 30 for b in blocks)
        got = fact.fact_apply(facts, staged, {}, SONG, CLOCK, order_by=["k"], stored=stored)
        new = {r.k: r.sk for r in got.new_rows.collect()}
        assert new == {f"k{i}": 60 + i for i in range(40, 60)}
        assert got.table.count() == 61 and got.table.where("is_valid").count() == 41


@pytest.mark.parametrize("seed", [0, 3])
def test_merge_in_blocks_is_the_merge(spark, seed, few_rows_at_once):
    rng = random.Random(300 + seed)
    target = [r[:3] for r in make_rows(rng, 60, 50, seed % 2 == 0)]
    source = unique([r[:3] for r in make_rows(rng, 60, 70, seed == 3)]) + [("n", "x", "y")] * 2
    t, s = (spark.createDataFrame(rows, "k string, a string, b string") for rows in (target, source))
    for call in ({"compare": ("a", "b")}, {"delete_missing": True}):
        blocks = merge.merge_blocks(t, s, "k", **call)
        assert len(blocks) > 4
        got = Counter(tuple(r) for b in blocks for r in b.collect())
        assert got == Counter(map(tuple, merge.merge(t, s, "k", **call).collect()))
    stats = keyed.key_stats(t, s, "k")
    assert keyed.key_blocks(t, s.withColumn("k", F.length("k")), "k", stats) == 1


def test_a_block_without_staged_rows_deletes_as_the_whole_does(spark, few_rows_at_once):
    """Whether missing rows go is decided by the whole snapshot, not by the block."""
    t = spark.createDataFrame([(f"k{i}", "x") for i in range(60)], "k string, a string")
    one, none = t.where("k = 'k1'"), t.limit(0)
    nameless = one.unionByName(spark.createDataFrame([(None, "x")], t.schema))
    for s, gone in ((one, 59), (none, 0), (nameless, 0)):
        blocks = merge.merge_blocks(t, s, "k", delete_missing=True)
        assert len(blocks) > 2
        assert sum(b.where("_op = 'delete'").count() for b in blocks) == gone


def test_first_load_again_in_blocks(spark, few_rows_at_once):
    """The first-load form on a loaded table, its next keys above those there."""
    facts = spark.createDataFrame(
        [(i, f"k{i}", "x", None, OLD, True) for i in range(40)], FACT
    ).withColumn("_source_file", F.lit("f"))
    rows = [(f"k{i}", "y", "z", "VALID") for i in range(20, 60)] + [("k1", "y", None, "BAD")]
    staged = spark.createDataFrame(rows, STAGED).withColumn("_load_timestamp", F.lit(OLD))
    assert len(fact.initial_blocks(facts, staged, {}, SONG, CLOCK)) == 4
    got = fact.fact_initial(facts, staged, {}, SONG, CLOCK, order_by=["k"])
    want = {(i, f"k{i}", "x" if i < 20 else "y", None) for i in range(40)}
    want |= {(i, f"k{i}", "y", "z") for i in range(40, 60)}
    assert {tuple(r) for r in got.table.select("sk", "k", "a", "b").collect()} == want


def test_counts_of_blocks_are_those_of_the_whole(spark, few_rows_at_once, folder):
    facts = spark.createDataFrame([(i, f"k{i}", "x", None, OLD, i % 3 > 0) for i in range(40)], FACT)
    staged = spark.createDataFrame([(f"k{i}", "y", None, "VALID") for i in range(20, 60)], STAGED)
    step = STEPS["fact_songs"]
    whole = tuple(audit.step_counts(fact.fact_changes(facts, staged, {}, SONG, CLOCK), step).first())
    assert whole == (40, 7, 13)
    blocks = fact.fact_blocks(facts, staged, {}, SONG, CLOCK)
    assert len(blocks) == 4
    assert tuple(audit.block_counts(spark, blocks, step).first()) == whole
    watched = audit.Watched(step)
    fact.fact_apply(facts, staged, {}, SONG, CLOCK, path=f"{folder}/t", kept=False, watch=watched)
    assert watched.counts == whole


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [p.rpartition("/")[2] for p in disk.getAllFiles().mkString("\n").splitlines()]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    moved = spark.range(1000).repartition(3).selectExpr("cast(id as string) k")
    before = shuffle_files(spark)
    kept = session.materialize([moved, moved.where("k > '5'")])
    keyed.key_stats(kept, moved, "k")
    until = time.time() + 20  # they are deleted in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == moved.count() + moved.where("k > '5'").count()
    assert spark.conf.get(session.FREE_SHUFFLES, None) is None
    spark.conf.set(session.FREE_SHUFFLES, "false")  # as somebody chose
    try:
        session.materialize(moved)
        assert shuffle_files(spark) - before
        assert spark.conf.get(session.FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(session.FREE_SHUFFLES)
