"""Files in, marts out: landing, streams, publishing, failure and retry."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakestrata.functions.scalar import try_timestamp_auto
from lakestrata.operators import checks, dedupe, scd2
from lakestrata.operators.audit import audit_summary
from lakestrata.plans.music import ALBUMS, ARTISTS, MODEL, SONGS
from lakestrata.sources import files, landing
from lakestrata.sources.store import Store
from lakestrata.streaming.flow import AUDIT, HISTORY, Flow

T0 = datetime(2024, 2, 1, 10)


def put(folder, name, lines, header="c"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join([header, *lines]) + "\n")


def inbox(folder, entity):
    return f"{folder}/inbox/{entity}"


def first_files(folder):
    put(
        inbox(folder, "songs"),
        "s 1+a.csv",
        [
            's1,"Song, ""One""",119700,http://s1,2024-01-01 10:11:12,l1,a1',
            "s2,Two,60000,http://s2,2024-01-02T10:11:12Z,l1,a1",
            "s3,Three,bad,http://s3,2024-01-02 10:11:12,l1,a2",
            "too,few",
        ],
    )
    put(inbox(folder, "artists"), "a1.csv", ["a1,Ann,http://a1", "a2,Bob,NULL"])
    put(inbox(folder, "albums"), "l1.csv", ["l1, First ,2020-05-06,10,http://l1"])


def make(spark, folder, hours=0):
    moment = T0 + timedelta(hours=hours)
    return Flow(spark, f"{folder}/root", f"{folder}/inbox", MODEL, now=lambda: moment)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_cycles(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    assert set(flow.run_cycle(T0).values()) == {"SUCCESS"}
    raw = flow.raw(SONGS)
    assert rows(raw, "song_id", "_source_file", "_file_row_number", "load_status") == [
        ("s1", "s 1+a.csv", 1, "LOADED"),
        ("s2", "s 1+a.csv", 2, "LOADED"),
        ("s3", "s 1+a.csv", 3, "LOADED"),
    ]
    assert rows(flow.rejects(SONGS), "_file_row_number", "bad_row") == [(4, "too,few")]
    history = flow.store.read(HISTORY).where("table_name = 'RAW_SONGS'")
    assert rows(history, "status", "row_count", "error_count", "first_error") == [
        ("PARTIALLY_LOADED", 3, 1, "too,few")
    ]
    assert rows(flow.store.read("stg_songs"), "song_id", "data_quality_flag") == [
        ("s1", "VALID"),
        ("s2", "VALID"),
        ("s3", "INVALID_DURATION"),
    ]
    assert rows(flow.store.read("songs_enriched"), "song_name", "song_duration_formatted") == [
        ('Song, "One"', "1:60"),
        ("Two", "1:00"),
    ]
    fact = flow.store.read("fact_songs")
    assert rows(fact, "song_sk", "song_id", "artist_sk", "album_sk", "is_valid") == [
        (1, "s1", 1, 1, True),
        (2, "s2", 1, 1, True),
    ]

    # Nothing new: every step is skipped and no table changes.
    before = flow.store.manifest()["versions"]
    assert set(flow.run_cycle(T0 + timedelta(minutes=5)).values()) == {"SKIPPED"}
    after = flow.store.manifest()["versions"]
    assert {k: v for k, v in before.items() if k != AUDIT} == {
        k: v for k, v in after.items() if k != AUDIT
    }

    # A second snapshot: s1 renamed, s2 gone, a1 renamed; the same name again is ignored.
    put(
        inbox(folder, "songs"),
        "s2.csv",
        ["s1,Uno,119700,http://s1,2024-01-01 10:11:12,l1,a1"],
    )
    put(inbox(folder, "artists"), "a2.csv", ["a1,Anna,http://a1", "a2,Bob,NULL"])
    put(inbox(folder, "albums"), "l1.csv", ["l9,Never seen,2020-05-06,10,http://l9"])
    later = T0 + timedelta(days=1)
    flow = make(spark, folder, 24)
    outcome = flow.run_cycle(later)
    assert outcome["raw_albums"] == outcome["stg_albums"] == outcome["dim_albums"] == "SKIPPED"
    assert outcome["fact_songs"] == "SUCCESS"
    artists = flow.dimension(MODEL.dimensions[0])
    assert rows(
        artists, "artist_sk", "artist_id", "artist_name", "eff_start_date", "eff_end_date"
    ) == [
        (1, "a1", "Ann", T0.date(), T0.date()),
        (2, "a2", "Bob", T0.date(), None),
        (3, "a1", "Anna", later.date(), None),
    ]
    fact = flow.store.read("fact_songs")
    assert rows(fact, "song_id", "song_name", "artist_sk", "is_valid") == [
        ("s1", "Uno", 3, True),
        ("s2", "Two", 1, False),
    ]
    assert rows(flow.store.read("artist_summary"), "artist_name", "total_songs") == [("Anna", 1)]
    summary = audit_summary(flow.store.read(AUDIT))
    assert rows(summary, "pipeline_run_id", "overall_status", "total_operations") == [
        ("20240201100000", "SUCCESS", 9),
        ("20240201100500", "SKIPPED", 9),
        ("20240202100000", "SUCCESS", 9),
    ]
    log = flow.store.read(AUDIT).where("pipeline_run_id = '20240202100000'")
    counts = rows(
        log.where("status = 'SUCCESS' and task_layer <> 'RAW'"),
        "target_table",
        "rows_inserted",
        "rows_updated",
        "rows_deleted",
    )
    # s3, invalid, was deleted from staging with s2.
    assert counts == [
        ("DIM_ARTISTS", 1, 1, 0),
        ("FACT_SONGS", 1, 0, 1),
        ("STG_ARTISTS", 2, 0, 0),
        ("STG_SONGS", 1, 0, 2),
    ]
    assert log.select("audit_id").distinct().count() == log.count()

    # A user's SQL over the views.
    flow.register_views()
    assert [tuple(r) for r in spark.sql(
        """select song_name, artist_name, song_duration_formatted from songs_enriched
           order by song_duration_ms desc limit 10"""
    ).collect()] == [("Uno", "Anna", "1:60")]
    assert spark.sql("select count(*) from dim_artists where not is_current").first()[0] == 1
    assert spark.sql("select max(load_status) from raw_songs").first()[0] == "LOADED"
    assert spark.sql("select overall_status from etl_pipeline_summary").count() == 3
    # Working tables go with the cycle that made them.
    assert not os.listdir(f"{folder}/root/_work/work")


def test_failure_keeps_state_and_retry_heals(spark, folder, monkeypatch):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)
    good = flow.store.manifest()["tables"]
    put(inbox(folder, "artists"), "a2.csv", ["a1,Anna,http://a1"])
    real = scd2.scd2_apply

    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr(scd2, "scd2_apply", broken)
    later = T0 + timedelta(days=1)
    with pytest.raises(RuntimeError, match="disk full"):
        flow.run_cycle(later)
    kept = flow.store.manifest()["tables"]
    assert kept["dim_artists"] == good["dim_artists"]
    failed = flow.store.read(AUDIT).where("status = 'FAILED'")
    assert rows(failed, "task_name", "error_message") == [
        ("TASK_LOAD_DIMENSIONS_ARTISTS", "disk full")
    ]
    monkeypatch.setattr(scd2, "scd2_apply", real)
    outcome = flow.run_cycle(later)
    assert outcome["stg_artists"] == "SKIPPED" and outcome["dim_artists"] == "SUCCESS"
    assert rows(scd2.current_rows(flow.store.read("dim_artists")), "artist_name") == [("Anna",)]


def test_failed_batch_comes_again(spark, folder, monkeypatch):
    """A snapshot leaves the queue only with the publication of its rows."""
    first_files(folder)
    flow = make(spark, folder)
    flow.land(ARTISTS, T0)
    real = flow._publish
    monkeypatch.setattr(flow, "_publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        flow.stage(ARTISTS, T0)
    assert flow.store.read("stg_artists").count() == 0
    monkeypatch.setattr(flow, "_publish", real)
    assert flow.stage(ARTISTS, T0)
    assert rows(flow.store.read("stg_artists"), "artist_id") == [("a1",), ("a2",)]
    assert not flow.stage(ARTISTS, T0)
    assert rows(flow.raw(ARTISTS), "load_status") == [("LOADED",), ("LOADED",)]


def test_duplicate_in_snapshot_fails_the_step(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)
    put(inbox(folder, "artists"), "a2.csv", ["a1,X,http://a1", "a1,Y,http://a1"])
    with pytest.raises(Exception, match="several source rows"):
        flow.run_cycle(T0 + timedelta(days=1))
    assert rows(flow.store.read("stg_artists"), "artist_id", "artist_name") == [
        ("a1", "Ann"),
        ("a2", "Bob"),
    ]


def test_all_rows_rejected_deletes_nothing(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)
    put(inbox(folder, "artists"), "a2.csv", ["only-one-field"])
    outcome = flow.run_cycle(T0 + timedelta(hours=2))
    assert outcome["raw_artists"] == "SUCCESS" and outcome["stg_artists"] == "SKIPPED"
    assert flow.store.read("stg_artists").count() == 2


def test_bulk_load_and_build(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    for entity in (SONGS, ARTISTS, ALBUMS):
        for _ in range(2):  # loading again replaces
            flow.bulk_load(entity, inbox(folder, entity.name), T0)
    flow.build(T0, T0.date())
    flow.register_views()
    assert spark.sql("select count(*) from stg_songs").first()[0] == 3
    assert rows(flow.store.read("fact_songs"), "song_id", "is_valid", "_source_file") == [
        ("s1", True, None),
        ("s2", True, None),
    ]
    # Rows loaded in bulk are not the stream's business.
    assert not flow.stage(ARTISTS, T0)
    described = checks.describe(flow.store.read("dim_artists"))
    assert described.where("column_name = 'artist_sk'").first()["data_type"] == "bigint"


def test_marts_refresh_by_lag(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)
    assert flow.refresh_marts(T0 + timedelta(minutes=59)) == []
    # Old enough, but nothing has changed.
    assert flow.refresh_marts(T0 + timedelta(minutes=61)) == []
    assert flow.store.refreshed("artist_summary") == T0 + timedelta(minutes=61)
    put(inbox(folder, "artists"), "a2.csv", ["a1,Anna,http://a1", "a2,Bob,NULL"])
    flow.run_cycle(T0 + timedelta(minutes=70))
    assert flow.refresh_marts(T0 + timedelta(minutes=130)) == ["songs_enriched", "artist_summary"]


def test_check_repair_and_backfill(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)

    def faults():
        return {(r[0], r[1]): r[2] for r in flow.check().collect() if r[2]}

    assert faults() == {}
    # Rows that a hand-made insert could leave behind.
    for spec in (MODEL.dimensions[0], MODEL.fact):
        again = flow.store.read(spec.table).withColumn(spec.surrogate, F.col(spec.surrogate) + 100)
        flow.store.publish(**flow.buckets(spec).change(None, again))
    assert faults()[("duplicate keys", "dim_artists")] == 2
    assert faults()[("duplicate keys", "fact_songs")] == 2
    assert faults()[("overlapping versions", "dim_artists")] == 2
    assert flow.repair(T0) == {"dim_artists": 2, "dim_albums": 0, "fact_songs": 2}
    assert rows(flow.store.read("dim_artists"), "artist_sk") == [(101,), (102,)]
    assert rows(flow.store.read("fact_songs"), "song_sk") == [(101,), (102,)]
    # The fact rows kept point to keys that went: that is reported, and not mended.
    assert faults() == {("orphans", "fact_songs"): 2}
    log = flow.store.read(AUDIT).where("operation = 'DEDUPLICATE'")
    assert rows(log, "target_table", "rows_deleted") == [("DIM_ARTISTS", 2), ("FACT_SONGS", 2)]
    put(inbox(folder, "albums"), "l2.csv", ["l1,Renamed,2020-05-06,10,http://l1"])
    flow.run_cycle(T0 + timedelta(days=3))
    flow.backfill(T0, (T0 + timedelta(days=9)).date())
    albums = flow.dimension(MODEL.dimensions[1])
    assert rows(albums, "album_name", "eff_start_date", "eff_end_date") == [
        ("First", T0.date(), (T0 + timedelta(days=1)).date()),
        ("Renamed", (T0 + timedelta(days=9)).date(), None),
    ]
    assert flow.store.read(AUDIT).where("operation = 'BACKFILL'").count() == 2


def test_row_numbers_over_many_splits(spark, folder):
    """Numbers restart per file and follow file order, however the file is cut."""
    path = f"{folder}/in"
    for name, n in (("a.csv", 20_000), ("b 1.csv", 3_000), ("c+d.csv", 1)):
        put(path, name, [f"{i},name {i},http://x/{i}" for i in range(1, n + 1)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        landed = landing.land(files.read_feed(spark, path, ARTISTS), ARTISTS, T0).raw
        wrong = landed.where(F.col("artist_id").cast("bigint") != F.col("_file_row_number"))
        assert wrong.count() == 0
        counts = checks.count_by(landed, "_source_file")
        assert rows(counts, "_source_file", "cnt") == [
            ("a.csv", 20_000),
            ("b 1.csv", 3_000),
            ("c+d.csv", 1),
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_listing_and_preview(spark, folder):
    first_files(folder)
    path = inbox(folder, "songs")
    assert files.list_files(spark, path).count() == 1
    assert files.preview(spark, path, SONGS, 2).count() == 2
    assert files.preview(spark, path, SONGS).columns == list(SONGS.columns)


def test_append_folders_fold(spark, folder, monkeypatch):
    from lakestrata.sources import store as module

    monkeypatch.setattr(module, "FOLD", 3)
    first = spark.range(3).selectExpr("id")
    store = module.Store(spark, f"{folder}/root", {"t": first.schema})
    for _ in range(7):
        store.publish(append={"t": [store.write("t", first)]})
        store.compact("t")
    assert store.read("t").count() == 21
    assert len(store.manifest()["tables"]["t"]) == 3
    store.vacuum()  # all of it is younger than the retention
    assert len(os.listdir(f"{folder}/root/tables/t")) > 3
    store.vacuum(timedelta(0))
    assert store.read("t").count() == 21
    assert len(os.listdir(f"{folder}/root/tables/t")) == 3


def test_vacuum_keeps_what_is_published_below_a_folder_named_tables(spark, folder):
    first = spark.range(3).selectExpr("id")
    store = Store(spark, f"{folder}/tables/music", {"t": first.schema})
    store.publish(replace={"t": [store.write("t", first)]})
    reader = store.read("t")
    for _ in range(3):
        store.publish(replace={"t": [store.write("t", first)]})
    store.vacuum()
    assert reader.count() == 3
    store.vacuum(timedelta(0))
    assert store.read("t").count() == 3
    assert len(os.listdir(f"{folder}/tables/music/tables/t")) == 1


def test_old_files_are_landed(spark, folder):
    path = inbox(folder, "artists")
    put(path, "new.csv", ["a1,Ann,http://a1"])
    flow = make(spark, folder)
    assert flow.land(ARTISTS, T0)
    put(path, "old.csv", ["a2,Bob,http://a2"])
    long_ago = os.path.getmtime(f"{path}/new.csv") - 20 * 86400
    os.utime(f"{path}/old.csv", (long_ago, long_ago))
    assert flow.land(ARTISTS, T0)
    assert rows(flow.raw(ARTISTS), "artist_id", "load_status") == [("a1", "NEW"), ("a2", "NEW")]
    put(path, "new.csv", ["a3,Cy,http://a3"])  # the same name again
    assert not flow.land(ARTISTS, T0)


def test_file_names_are_forgotten_after_two_weeks(spark, folder):
    path = inbox(folder, "artists")
    put(path, "a.csv", ["a1,Ann,http://a1"])
    flow = make(spark, folder)
    assert flow.land(ARTISTS, T0)
    put(path, "a.csv", ["a1,Anna,http://a1"])
    assert not flow.land(ARTISTS, T0 + timedelta(days=13))
    assert flow.land(ARTISTS, T0 + timedelta(days=15))
    assert rows(flow.raw(ARTISTS), "artist_name", "batch_id") == [("Ann", 0), ("Anna", 1)]
    # Loaded again, it is refused again, and other tables' names do not matter.
    assert not flow.land(ARTISTS, T0 + timedelta(days=28))
    put(inbox(folder, "albums"), "a.csv", ["l1,First,2020-05-06,10,http://l1"])
    assert flow.land(ALBUMS, T0 + timedelta(days=15))


def test_snapshots_between_cycles_are_staged_one_by_one(spark, folder):
    first_files(folder)
    flow = make(spark, folder)
    flow.run_cycle(T0)
    path = inbox(folder, "artists")
    # Two files, then a folder of two part files.
    put(path, "z-first.csv", ["a1,Anna,http://a1", "a3,Cy,http://a3"])
    put(path, "a-second.csv", ["a1,Anne,http://a1", "a4,Di,http://a4"])
    for i, name in enumerate(("part-0.csv", "part-1.csv")):
        put(f"{path}/third", name, [f"a{1 + 3 * i},Part {i},http://a{1 + 3 * i}"])
    base = os.path.getmtime(f"{path}/a1.csv")
    for i, name in enumerate(("z-first.csv", "a-second.csv", "third/part-0.csv", "third/part-1.csv")):
        os.utime(f"{path}/{name}", (base + 10 + i, base + 10 + i))
    later = T0 + timedelta(days=1)
    flow.land(ARTISTS, later)
    assert [batch for batch, _ in flow.queue(ARTISTS)] == [1, 2, 3]
    outcome = flow.run_cycle(later)
    assert outcome["stg_artists"] == outcome["dim_artists"] == "SUCCESS"
    assert flow.queue(ARTISTS) == []
    names = flow.raw(ARTISTS).where("batch_id = 3")
    assert rows(names, "_source_file") == [("third/part-0.csv",), ("third/part-1.csv",)]
    assert rows(flow.store.read(HISTORY).where("source_file like 'third/%'"), "row_count") == [
        (1,),
        (1,),
    ]
    assert rows(flow.store.read("stg_artists"), "artist_id", "artist_name") == [
        ("a1", "Part 0"),
        ("a4", "Part 1"),
    ]
    log = flow.store.read(AUDIT).where("target_table = 'STG_ARTISTS' and status = 'SUCCESS'")
    assert [r[1:] for r in rows(log, "audit_id", "rows_inserted", "rows_deleted")] == [
        (2, 0),  # a1, a2
        (2, 1),  # a3 for a2
        (2, 1),  # a4 for a3
        (2, 0),
    ]


def test_latest_row_of_a_key_if_asked_for(spark, folder):
    first_files(folder)
    flow = Flow(spark, f"{folder}/root", f"{folder}/inbox", MODEL, dedupe="latest")
    flow.run_cycle(T0)
    put(
        inbox(folder, "artists"),
        "a2.csv",
        ["a1,X,http://a1", " a1 ,Y,http://a1", "a2,Bob,NULL", ",No key,http://x", ",No key,http://x"],
    )
    flow.run_cycle(T0 + timedelta(days=1))
    assert sorted(
        (r["artist_id"] or "", r["artist_name"]) for r in flow.store.read("stg_artists").collect()
    ) == [("", "No key"), ("", "No key"), ("a1", "Y"), ("a2", "Bob")]


def test_nothing_of_a_failed_landing_is_visible(spark, folder, monkeypatch):
    first_files(folder)
    flow = make(spark, folder)
    monkeypatch.setattr(flow.store, "publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        flow.land(SONGS, T0)
    monkeypatch.undo()
    assert flow.raw(SONGS).count() == flow.rejects(SONGS).count() == 0
    assert flow.store.read(HISTORY).count() == 0 and flow.queue(SONGS) == []
    assert flow.land(SONGS, T0)
    assert flow.raw(SONGS).count() == 3 and flow.rejects(SONGS).count() == 1


def test_bulk_load_keeps_what_waits(spark, folder):
    path = inbox(folder, "artists")
    put(path, "a.csv", ["a1,Ann,http://a1"])
    flow = make(spark, folder)
    flow.land(ARTISTS, T0)
    put(f"{folder}/other", "b.csv", ["a2,Bob,http://a2"])
    flow.bulk_load(ARTISTS, f"{folder}/other", T0)
    assert rows(flow.raw(ARTISTS), "artist_id", "batch_id") == [("a1", 0), ("a2", -1)]
    assert flow.stage(ARTISTS, T0)
    assert rows(flow.store.read("stg_artists"), "artist_id") == [("a1",)]


def test_a_landed_file_without_rows_has_history(spark, folder):
    put(inbox(folder, "artists"), "empty.csv", [])
    flow = make(spark, folder)
    assert flow.land(ARTISTS, T0)
    assert rows(flow.store.read(HISTORY), "source_file", "status", "row_count") == [
        ("empty.csv", "LOADED", 0)
    ]
    assert not flow.stage(ARTISTS, T0) and flow.queue(ARTISTS) == []


def test_short_and_long_rows(spark, folder):
    lines = ["a1,Ann,http://a1", "a2,Bob", "a3,Cy,http://a3,more", 'a4,"D, ""D""",u,v', 'a5,"E']
    put(f"{folder}/in", "a.csv", lines)
    feed = files.read_feed(spark, f"{folder}/in", ARTISTS)
    for short, long, kept in (
        ("reject", "reject", ["a1"]),
        ("keep", "reject", ["a1", "a2"]),
        ("reject", "keep", ["a1", "a3", "a4"]),
        ("keep", "keep", ["a1", "a2", "a3", "a4"]),
    ):
        got = landing.land(feed, ARTISTS, T0, short_rows=short, long_rows=long)
        assert [r[0] for r in rows(got.raw, "artist_id")] == kept
        assert got.rejects.count() == 5 - len(kept)
    both = landing.land(feed, ARTISTS, T0, short_rows="keep", long_rows="keep").raw
    assert rows(both.where("artist_id in ('a2', 'a4')"), "artist_name", "external_url") == [
        ("Bob", None),
        ('D, "D"', "u"),
    ]
    with pytest.raises(ValueError):
        landing.land(feed, ARTISTS, T0, short_rows="perhaps")


def test_a_small_change_leaves_other_buckets_alone(spark, folder):
    """1 % of 300 artists change: their buckets are written anew, all others keep their files."""
    names = {i: f"Name {i}" for i in range(300)}
    path = inbox(folder, "artists")

    def snapshot(name):
        put(path, name, [f"a{i},{text},http://a{i}" for i, text in names.items()])

    def folders():
        spec = MODEL.dimensions[0]
        return {b: tuple(p) for b, p in flow.buckets(spec).folders().items()}

    snapshot("a1.csv")
    put(inbox(folder, "albums"), "l1.csv", ["l1, First ,2020-05-06,10,http://l1"])
    songs = {i: f"Song {i}" for i in range(300)}
    put(
        inbox(folder, "songs"),
        "s1.csv",
        [f"s{i},{t},60000,http://s,2024-01-01 10:11:12,l1,a{i}" for i, t in songs.items()],
    )
    flow = make(spark, folder)
    flow.run_cycle(T0)
    before, fact_before = folders(), flow.buckets(MODEL.fact).folders()
    assert sum(len(p) for p in before.values()) == len(before) > 50
    names.update({i: "New name" for i in (7, 8, 9)})
    snapshot("a2.csv")
    later = T0 + timedelta(days=1)
    flow.run_cycle(later)
    after, fact_after = folders(), flow.buckets(MODEL.fact).folders()
    assert 1 <= sum(before[b] != after.get(b) for b in before) <= 3
    # Songs of the renamed artists have new keys; the rest of the fact table stays.
    assert 1 <= sum(fact_before[b] != fact_after.get(b) for b in fact_before) <= 3
    current = flow.store.read("dim_artists")
    assert current.count() == 300 and flow.dimension(MODEL.dimensions[0]).count() == 303
    assert current.where("artist_name = 'New name'").count() == 3
    fact = flow.store.read("fact_songs")
    assert fact.count() == fact.select("song_id").distinct().count() == 300
    assert sorted(r[0] for r in fact.where("artist_sk > 300").select("song_id").collect()) == [
        "s7",
        "s8",
        "s9",
    ]
    # Another number of buckets: the next change cuts the table anew.
    flow = Flow(spark, f"{folder}/root", f"{folder}/inbox", MODEL, buckets=4)
    names[7] = "Newer"
    snapshot("a3.csv")
    flow.run_cycle(later + timedelta(days=1))
    assert set(flow.buckets(MODEL.dimensions[0]).folders()) == {0, 1, 2, 3}
    assert flow.store.read("dim_artists").count() == 300


def test_full_buckets_are_folded_and_keyless_rows_have_their_own(spark, folder, monkeypatch):
    from pyspark.sql import types as T

    from lakestrata.sources import buckets as module

    monkeypatch.setattr(module, "FOLD", 3)
    schema = T.StructType([T.StructField("sk", T.LongType()), T.StructField("k", T.StringType())])
    store = Store(spark, f"{folder}/root", {"t": schema})
    cut = module.Buckets(store, "t", "k", "sk", 2)
    for i in range(6):
        new = spark.createDataFrame([(3 * i, "x"), (3 * i + 1, "y"), (3 * i + 2, None)], schema)
        state = cut.change(None, new)
        store.publish(**state)
    assert store.read("t").count() == 18
    held = cut.folders()
    assert -1 in held and all(len(p) <= 4 for p in held.values())
    gone = store.read("t").where("sk in (0, 2)")
    store.publish(**cut.change(gone, spark.createDataFrame([], schema)))
    assert sorted(r["sk"] for r in store.read("t").collect()) == [1, *range(3, 18)]


def test_siblings_run_side_by_side(spark, folder, monkeypatch):
    import threading

    first_files(folder)
    flow = make(spark, folder)
    waiting = threading.Barrier(3, timeout=60)
    real = flow.land

    def land(*args):
        waiting.wait()  # goes on only if all three are here
        return real(*args)

    monkeypatch.setattr(flow, "land", land)
    assert set(flow.run_cycle(T0).values()) == {"SUCCESS"}
    log = flow.store.read(AUDIT)
    assert log.select("audit_id").distinct().count() == log.count() == 9


def test_following_runs_cycles_until_it_is_stopped(spark, folder, monkeypatch):
    import threading

    os.makedirs(inbox(folder, "artists"))
    flow = make(spark, folder)
    # Empty and missing folders: nothing to land.
    assert set(flow.run_cycle(T0).values()) == {"SKIPPED"}
    calls, enough = [], threading.Event()

    def cycle(run_ts):
        calls.append(run_ts)
        if len(calls) >= 3:
            enough.set()

    monkeypatch.setattr(flow, "run_cycle", cycle)
    query = flow.follow("1 second")
    try:
        assert enough.wait(60)
    finally:
        query.stop()
    assert calls[:3] == [T0] * 3


def test_landing_moves_no_row(spark, folder):
    """Row numbers and keys are projections over the written rows, whatever the join settings."""
    from lakestrata.operators import keys

    put(f"{folder}/in", "a.csv", ["a1,Ann,http://a1"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landed = landing.land(files.read_feed(spark, f"{folder}/in", ARTISTS), ARTISTS, T0)
        numbered = keys.number_rows(spark.range(10).selectExpr("id k"), "sk")
        for df in (landed.raw, landed.rejects, numbered):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    empty = keys.number_rows(spark.range(0).selectExpr("id k"), "sk")
    assert empty.count() == 0


def test_bulk_loads_are_recorded(spark, folder):
    path = inbox(folder, "artists")
    put(path, "a.csv", ["a1,Ann,http://a1", "bad"])
    put(path, "empty.csv", [])
    flow = make(spark, folder)
    flow.bulk_load(ARTISTS, path, T0)
    assert rows(flow.store.read(HISTORY), "source_file", "status", "row_count", "error_count") == [
        ("a.csv", "PARTIALLY_LOADED", 1, 1),
        ("empty.csv", "LOADED", 0, 0),
    ]
    assert rows(flow.store.read(AUDIT), "status", "rows_inserted") == [("SUCCESS", 1)]
    assert rows(flow.raw(ARTISTS), "load_status") == [("NEW",)]
    flow.build(T0, T0.date())
    assert rows(flow.raw(ARTISTS), "load_status") == [("LOADED",)]


def test_unknown_current_rows_stay(spark):
    dim = spark.createDataFrame(
        [(1, "a", True), (2, "a", True), (3, "a", None), (4, "a", False), (None, "b", True)],
        "sk bigint, id string, is_current boolean",
    )
    kept = dedupe.keep_latest_current(dim, "id", "sk")
    assert {r["sk"] for r in kept.collect()} == {2, 3, 4, None}
    assert {r["sk"] for r in scd2.closed_rows(dim).collect()} == {3, 4}


def test_times_with_a_zone_keep_the_clock(spark):
    texts = [
        "2024-01-01T10:00:00+02:00",
        "2024-01-01T10:00:00+0200",
        "2024-01-01 10:00:00 +0200",
        "2024-01-01 10:00:00.5Z",
        "2024-01-01 10:00",
        "2024-01-01",
        "01-01",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in df.orderBy("i").select(try_timestamp_auto("t")).collect()]
    ten = datetime(2024, 1, 1, 10)
    assert found == [ten, ten, ten, ten.replace(microsecond=500_000), ten, datetime(2024, 1, 1), None]
