"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import Entity
from lakestrata.functions import scalar
from lakestrata.functions.quality import quality_flag, quality_summary, valid_rows
from lakestrata.operators import audit, checks, dedupe, fact, keys, merge, scd2, sets
from lakestrata.plans import marts
from lakestrata.plans.music import (
    ALBUMS,
    ARTISTS,
    DIM_ALBUMS,
    DIM_ARTISTS,
    FACT_SONGS,
    SCHEMAS,
    SONGS,
    STEPS,
)
from lakestrata.plans.staging import stage_delta, stage_full
from lakestrata.session import materialize, shared_dir, side_by_side
from lakestrata.sources import files, landing
from registry import feeds

FIRST = scd2.Clock(feeds.RUN_DATE, feeds.RUN_TS)
SECOND = scd2.Clock(feeds.NEXT_DATE, feeds.NEXT_TS)
EVENT_DAY = datetime(2024, 1, 30)
TASKS = ("TASK_LOAD_STAGING_SONGS", "TASK_LOAD_FACTS", "TASK_LOAD_DIMENSIONS_ALBUMS")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register ``function(Data) -> DataFrame`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(Data(spark, sf_dir)))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers leave as bigint, whatever they were inside."""
    whole = (T.IntegerType, T.DecimalType)
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name)
            if isinstance(f.dataType, whole)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Data:
    """The given tables, the feeds made of them, and the states built from those."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        for name in ("lineitem", "part", "supplier", "events", "customer", "orders"):
            if name in text:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def raw(self, text: str, entity: Entity, at: datetime = feeds.RUN_TS) -> DataFrame:
        rows = landing.clean_text(self.sql(text).select(*entity.columns), entity.columns)
        return merge.with_defaults(rows, landing.raw_defaults(at))

    def staged(self, text: str, entity: Entity) -> DataFrame:
        return stage_full(self.raw(text, entity), entity, feeds.RUN_TS)

    def delta(self, text: str, entity: Entity) -> DataFrame:
        return stage_delta(self.raw(text, entity, feeds.NEXT_TS), entity, feeds.NEXT_TS)

    def stored(self, text: str, entity: Entity) -> DataFrame:
        """Staging as the stored table it is to later steps, which read it repeatedly."""
        return materialize(self.staged(text, entity))

    def stored_delta(self, text: str, entity: Entity) -> DataFrame:
        return materialize(self.delta(text, entity))

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[table])

    def dim(self, spec, staged: DataFrame) -> DataFrame:
        """A dimension after its first load."""
        first = scd2.scd2_apply(
            self.empty(spec.table),
            materialize(staged),
            spec,
            FIRST,
            start_key=0,
            order_by=[spec.key],
            compare=spec.initial_compare,
            close_missing=False,
            reopen=False,
        )
        return first.current

    def artists(self, text: str = feeds.ARTISTS_V1_KEYED) -> DataFrame:
        return self.dim(DIM_ARTISTS, self.staged(text, ARTISTS))

    def albums(self, text: str = feeds.ALBUMS_V1_KEYED) -> DataFrame:
        return self.dim(DIM_ALBUMS, self.staged(text, ALBUMS))

    def dims(self) -> dict[str, DataFrame]:
        artists, albums = side_by_side(self.spark, self.artists, self.albums)
        return {"dim_artists": artists, "dim_albums": albums}

    def next_dim(self, spec, current: DataFrame, staged: DataFrame) -> DataFrame:
        """All versions after the next cycle."""
        return scd2.scd2_apply(
            current, materialize(staged), spec, SECOND, order_by=[spec.key]
        ).table(scd2.closed_rows(current))

    def fact(self, dims: dict[str, DataFrame], text: str = feeds.SONGS_V1_KEYED) -> DataFrame:
        """The fact table after its first load; one song in five was invalidated."""
        first = fact.fact_initial(
            self.empty("fact_songs"),
            self.staged(text, SONGS),
            dims,
            FACT_SONGS,
            FIRST,
            start_key=0,
            order_by=["song_id"],
        ).table
        return first.withColumn("is_valid", F.col("song_duration_ms") % 5 != 0)

    def songs(
        self,
        dims: dict[str, DataFrame],
        text: str = feeds.SONGS_V1_KEYED,
        read: Collection[str] = ("artist_sk", "album_sk"),
    ) -> DataFrame:
        """The same rows without their surrogate keys, for what does not read these: nothing
        is written or put in order, and only the columns that are read are shuffled.  Of the
        dimensions' keys there are those ``read``."""
        spec = fact.without_unread(FACT_SONGS, dims, read)
        first = fact.initial_changes(
            self.empty("fact_songs"), self.staged(text, SONGS), dims, spec, FIRST
        )
        unread = [k.surrogate for k in FACT_SONGS.lookups if k.surrogate not in read]
        return (
            merge.state(first)
            .drop("song_sk", *unread)
            .withColumn("is_valid", F.col("song_duration_ms") % 5 != 0)
        )

    def numbered(self, songs: DataFrame, *columns: str) -> DataFrame:
        """These columns of ``songs`` with the surrogate keys of the first load."""
        return keys.assign_keys(songs.select("song_id", *columns), "song_sk", 0, ["song_id"])


# -- landing ----------------------------------------------------------------------


def _land(data: Data, text: str, entity: Entity) -> DataFrame:
    path = f"{shared_dir(data.spark)}/feeds/{uuid.uuid4().hex}"
    files.write_feed(data.sql(text), path, entity)
    rows = files.read_feed(data.spark, path, entity)
    return landing.land(rows, entity, feeds.RUN_TS).raw.drop("_source_file", "_file_row_number")


@query
def land_songs(data: Data) -> DataFrame:
    """Write the feed as CSV files, land them."""
    return _land(data, feeds.songs(), SONGS)


@query
def land_artists(data: Data) -> DataFrame:
    return _land(data, feeds.artists(), ARTISTS)


@query
def land_albums(data: Data) -> DataFrame:
    return _land(data, feeds.ALBUMS_V1, ALBUMS)


@query
def land_rejects(data: Data) -> DataFrame:
    """Lines with a field too few or too many are rejected, with their text."""
    path = f"{shared_dir(data.spark)}/feeds/{uuid.uuid4().hex}"
    data.sql(feeds.ARTIST_LINES).select("line").write.text(path)
    rows = files.read_feed(data.spark, path, ARTISTS, header="false")
    return landing.land(rows, ARTISTS, feeds.RUN_TS).rejects.select("bad_row")


@query
def land_lineage(data: Data) -> DataFrame:
    """Every landed row has a place of its own, and the places of a file count its rows."""
    path = f"{shared_dir(data.spark)}/feeds/{uuid.uuid4().hex}"
    files.write_feed(data.sql(feeds.songs()), path, SONGS)
    rows = landing.land(files.read_feed(data.spark, path, SONGS), SONGS, feeds.RUN_TS).raw
    per_file = rows.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("_file_row_number").alias("places"),
        F.min("_file_row_number").alias("first"),
        F.max("_file_row_number").alias("last"),
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"),
        F.sum("places").alias("n_places"),
        F.sum("last").alias("last_places"),
        F.max("first").alias("first_place"),
    )


@query
def short_long_rows(data: Data) -> DataFrame:
    """Raw rows and rejects under each policy for lines with a field too few or too many."""
    path = f"{shared_dir(data.spark)}/feeds/{uuid.uuid4().hex}"
    data.sql(feeds.ARTIST_LINES).select("line").write.text(path)
    rows = files.read_feed(data.spark, path, ARTISTS, header="false")
    out = None
    for short in (landing.KEEP, landing.REJECT):
        for long in (landing.KEEP, landing.REJECT):
            landed = landing.land(rows, ARTISTS, feeds.RUN_TS, short_rows=short, long_rows=long)
            bad = landed.rejects.agg(F.count(F.lit(1)).alias("n_rejects"))
            one = landed.raw.agg(
                F.count(F.lit(1)).alias("n_rows"), F.count("external_url").alias("n_urls")
            ).select(F.lit(short).alias("short_rows"), F.lit(long).alias("long_rows"), "*")
            one = one.crossJoin(bad)  # one row each
            out = one if out is None else out.unionByName(one)
    return out


@query
def null_tokens(data: Data) -> DataFrame:
    return landing.clean_text(data.sql(feeds.TOKENS), SONGS.columns)


@query
def load_history(data: Data) -> DataFrame:
    loads = data.sql(feeds.LOADS).withColumn("_load_timestamp", scalar.ts(feeds.RUN_TS))
    history = landing.load_history(
        "RAW_SONGS",
        loads.where(F.col("bad_row").isNull()),
        loads.where(F.col("bad_row").isNotNull()),
    )
    return landing.recent_loads(history, feeds.NEXT_TS)


@query
def raw_counts(data: Data) -> DataFrame:
    return checks.row_counts(
        {
            "RAW_SONGS": data.raw(feeds.songs(), SONGS),
            "RAW_ARTISTS": data.raw(feeds.artists(), ARTISTS),
            "RAW_ALBUMS": data.raw(feeds.ALBUMS_V1, ALBUMS),
        }
    )


@query
def load_status_counts(data: Data) -> DataFrame:
    batches = data.sql(feeds.songs()).withColumn("batch_id", F.col("h") % 4)
    return checks.count_by(landing.with_load_status(batches, 2), "load_status")


@query
def latest_load(data: Data) -> DataFrame:
    events = data.table("events").withColumn("_load_timestamp", F.date_trunc("day", "ts"))
    return marts.latest_load(events).select("event_id", "user_id")


@query
def add_column_default(data: Data) -> DataFrame:
    suppliers = data.table("supplier").select("s_suppkey", "s_name")
    flagged = merge.add_column(suppliers, "is_valid", F.lit(True))
    return merge.add_column(flagged, "s_name", F.lit("unused"))


@query
def stream_actions(data: Data) -> DataFrame:
    """The change feed of an append-only table, read as a stream."""
    out = f"{shared_dir(data.spark)}/work/{uuid.uuid4().hex}"
    schema = data.table("lineitem").schema
    stream = (
        data.spark.readStream.schema(schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(data.sf_dir)
    )

    def count(batch: DataFrame, batch_id: int) -> None:
        actions = batch.withColumn("action", F.lit("INSERT"))
        checks.count_by(actions, "action", "n").write.mode("overwrite").parquet(
            f"{out}/result/batch_id={batch_id}"
        )

    started = (
        stream.writeStream.foreachBatch(count)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    counts = data.spark.read.parquet(f"{out}/result")
    return counts.groupBy("action").agg(F.sum("n").alias("n"))


# -- staging and quality --------------------------------------------------------------


@query
def stage_songs(data: Data) -> DataFrame:
    return data.staged(feeds.songs(), SONGS)


@query
def stage_artists(data: Data) -> DataFrame:
    return data.staged(feeds.artists(), ARTISTS)


@query
def stage_albums(data: Data) -> DataFrame:
    return data.staged(feeds.ALBUMS_V1, ALBUMS)


@query
def stage_songs_inc(data: Data) -> DataFrame:
    return data.delta(feeds.SONGS_V2, SONGS)


@query
def stage_artists_inc(data: Data) -> DataFrame:
    return data.delta(feeds.ARTISTS_V2, ARTISTS)


@query
def stage_albums_inc(data: Data) -> DataFrame:
    return data.delta(feeds.ALBUMS_V2, ALBUMS)


@query
def try_timestamp_forms(data: Data) -> DataFrame:
    """Times as feeds write them; a zone is dropped and the clock time counts."""
    return data.sql(feeds.TIME_TEXTS).select(
        "o_orderkey", scalar.try_timestamp_auto("t").alias("ts")
    )


@query
def quality_flags(data: Data) -> DataFrame:
    """The first failing rule of each song, out of five."""
    return (
        data.raw(feeds.songs(), SONGS)
        .withColumns(SONGS.parse())
        .select("song_url", quality_flag(SONGS.rules).alias("data_quality_flag"))
    )


@query
def quality_summary_all(data: Data) -> DataFrame:
    return quality_summary(
        {
            "STG_SONGS": data.staged(feeds.songs(), SONGS),
            "STG_ARTISTS": data.staged(feeds.artists(), ARTISTS),
            "STG_ALBUMS": data.staged(feeds.ALBUMS_V1, ALBUMS),
        }
    )


# -- predicates and set tests -----------------------------------------------------------


@query
def filter_current(data: Data) -> DataFrame:
    first = data.albums()
    both = data.next_dim(DIM_ALBUMS, first, data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS))
    return scd2.current_rows(both).select("album_sk", "album_id", "eff_start_date")


@query
def filter_in_list(data: Data) -> DataFrame:
    log = data.sql(feeds.AUDIT)
    return log.where(F.col("task_name").isin(list(TASKS))).select("audit_id", "task_name")


@query
def recent_range(data: Data) -> DataFrame:
    since = scalar.ts(EVENT_DAY) - F.make_dt_interval(days=F.lit(1))
    return data.table("events").where(F.col("ts") >= since).select("event_id", "ts")


@query
def run_id_format(data: Data) -> DataFrame:
    return data.table("events").select("event_id", scalar.run_id(F.col("ts")).alias("run_id"))


@query
def change_detect(data: Data) -> DataFrame:
    """Which albums differ between two snapshots; NULL counts as no difference."""
    old = data.staged(feeds.ALBUMS_V1_KEYED, ALBUMS).alias("o")
    new = data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS).alias("n")
    compare = DIM_ALBUMS.compare
    return old.join(new, F.col("o.album_id") == F.col("n.album_id")).select(
        F.col("o.album_id").alias("album_id"),
        scalar.changed("o", "n", compare).alias("is_changed"),
        scalar.changed("o", "n", compare, null_safe=True).alias("is_changed_null_safe"),
    )


@query
def semi_in(data: Data) -> DataFrame:
    songs = data.staged(feeds.SONGS_V1, SONGS)
    valid = data.delta(feeds.SONGS_V2, SONGS).where("data_quality_flag = 'VALID'")
    return sets.semi_in(songs, valid, "song_id").select("song_id", "song_name")


def _not_in(data: Data, new: str) -> DataFrame:
    songs = data.staged(feeds.SONGS_V1, SONGS)
    return sets.anti_not_in(songs, data.stored_delta(new, SONGS), "song_id").select(
        "song_id", "song_name"
    )


@query
def anti_not_in(data: Data) -> DataFrame:
    return _not_in(data, feeds.SONGS_V2_KEYED)


@query
def anti_not_in_null_keys(data: Data) -> DataFrame:
    """A NULL on the right: nothing qualifies."""
    return _not_in(data, feeds.SONGS_V2)


@query
def anti_not_in_empty(data: Data) -> DataFrame:
    """An empty right side: everything qualifies, rows without a key too."""
    songs = data.staged(feeds.SONGS_V1, SONGS)
    none = data.delta(feeds.SONGS_V2, SONGS).where("data_quality_flag = 'NO SUCH FLAG'")
    return sets.anti_not_in(songs, none, "song_id").select("song_id", "song_name")


def _guarded(data: Data, new: str) -> DataFrame:
    songs = data.staged(feeds.SONGS_V1, SONGS)
    return sets.guarded_delete(songs, data.stored_delta(new, SONGS), "song_id").select(
        "song_id", "song_name", "data_quality_flag"
    )


@query
def guarded_delete(data: Data) -> DataFrame:
    return _guarded(data, feeds.SONGS_V2_KEYED)


@query
def guarded_delete_null_keys(data: Data) -> DataFrame:
    return _guarded(data, feeds.SONGS_V2)


# -- merge ------------------------------------------------------------------------------


@query
def merge_upsert(data: Data) -> DataFrame:
    """Two versions of the whole table; every third customer has a new key in the second."""
    customer = data.table("customer").select("c_custkey", "c_name", "c_acctbal")
    source = customer.select(
        F.when(F.col("c_custkey") % 3 == 0, -1 - F.col("c_custkey"))
        .otherwise(F.col("c_custkey"))
        .alias("c_custkey"),
        F.concat("c_name", F.lit(" v2")).alias("c_name"),
    )
    return merge.merge(
        customer, source, "c_custkey", defaults={"c_acctbal": F.lit(0.0)}
    ).withColumnRenamed(merge.OP, "op")


@query
def merge_dup_new_keys(data: Data) -> DataFrame:
    """Odd customers come under a few new keys: all their rows are inserted."""
    customer = data.table("customer").select("c_custkey", "c_name", "c_acctbal")
    source = customer.select(
        F.when(F.col("c_custkey") % 2 == 1, -1 - F.col("c_custkey") % 10)
        .otherwise(F.col("c_custkey"))
        .alias("c_custkey"),
        F.concat("c_name", F.lit(" v2")).alias("c_name"),
    )
    return merge.merge(customer, source, "c_custkey").withColumnRenamed(merge.OP, "op")


@query
def merge_songs(data: Data) -> DataFrame:
    changes = merge.merge(
        data.staged(feeds.SONGS_V1, SONGS), data.delta(feeds.SONGS_V2, SONGS), "song_id"
    )
    return merge.state(changes)


@query
def merge_artists(data: Data) -> DataFrame:
    changes = merge.merge(
        data.stored(feeds.ARTISTS_V1, ARTISTS),
        data.stored_delta(feeds.ARTISTS_V2, ARTISTS),
        "artist_id",
    )
    return merge.state(changes)


@query
def merge_albums(data: Data) -> DataFrame:
    changes = merge.merge(
        data.stored(feeds.ALBUMS_V1, ALBUMS), data.stored_delta(feeds.ALBUMS_V2, ALBUMS), "album_id"
    )
    return merge.state(changes)


@query
def merge_snapshot(data: Data) -> DataFrame:
    """Merge and guarded delete in one join."""
    changes = merge.merge(
        data.staged(feeds.SONGS_V1_KEYED, SONGS),
        data.delta(feeds.SONGS_V2_KEYED, SONGS),
        "song_id",
        delete_missing=True,
        whole_deletes=False,
    )
    return merge.state(changes)


@query
def merge_null_keys(data: Data) -> DataFrame:
    """Rows without a key after merging a snapshot: old ones stay, new ones come in."""
    changes = merge.merge(
        data.staged(feeds.SONGS_V1, SONGS), data.delta(feeds.SONGS_V2, SONGS), "song_id"
    )
    return merge.state(changes).where(F.col("song_id").isNull()).select(
        "song_url", "song_name", "_load_timestamp"
    )


@query
def merge_counts(data: Data) -> DataFrame:
    changes = merge.merge(
        data.staged(feeds.SONGS_V1_KEYED, SONGS),
        data.delta(feeds.SONGS_V2_KEYED, SONGS),
        "song_id",
        delete_missing=True,
    )
    return merge.change_counts(changes).withColumnRenamed(merge.OP, "op")


@query
def merge_duplicates(data: Data) -> DataFrame:
    """Line keys that several rows of a feed would update."""
    lines = data.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"), "l_quantity"
    )
    target = lines.where(F.col("l_quantity") > 25)
    return merge.duplicate_updates(target, lines, "line_key")


@query
def merge_fact(data: Data) -> DataFrame:
    dims = data.dims()
    source = fact.lookup_keys(
        valid_rows(data.delta(feeds.SONGS_V2_KEYED, SONGS)),
        dims,
        FACT_SONGS.lookups,
    ).select("song_id", *FACT_SONGS.attributes)
    blocks = merge.merge_blocks(
        materialize(data.songs(dims), compression="zstd"),
        materialize(source, compression="zstd"),
        "song_id",
        compare=FACT_SONGS.compare,
        defaults={"is_valid": F.lit(True), "_load_timestamp": SECOND.now},
    )
    changes = blocks[0] if len(blocks) == 1 else materialize(blocks, compression="zstd")
    return changes.withColumnRenamed(merge.OP, "op")


# -- keys, clean-up, backfill ---------------------------------------------------------------


@query
def surrogate_keys(data: Data) -> DataFrame:
    songs = data.staged(feeds.SONGS_V1, SONGS).where("data_quality_flag = 'VALID'")
    return keys.assign_keys(
        songs.select("song_id", "song_name"), "song_sk", start=1000, order_by=["song_id"]
    )


@query
def dedupe_latest(data: Data) -> DataFrame:
    events = data.table("events").select("event_id", "user_id", "event_type")
    return dedupe.keep_latest(events, "user_id", "event_id")


@query
def dedupe_unknown_current(data: Data) -> DataFrame:
    """Rows of which it is not known whether they are current stay."""
    rows = data.table("events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 5 > 0, F.col("event_type") != "view").alias("is_current"),
    )
    return dedupe.keep_latest_current(rows, "user_id", "event_id")


@query
def dedupe_latest_rows(data: Data) -> DataFrame:
    """The last event of each user, by time and number; users' keys come with blanks."""
    rows = data.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 7 > 0, F.concat(F.lit(" "), F.col("user_id"))).alias("k"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )
    return dedupe.latest_rows(rows, F.trim("k"), ("ts", "event_id")).select("event_id", "k")


@query
def dedupe_latest_dim(data: Data) -> DataFrame:
    events = data.table("events").select(
        "event_id", "user_id", (F.col("event_type") != "view").alias("is_current")
    )
    return dedupe.keep_latest_current(events, "user_id", "event_id")


@query
def backfill_dates(data: Data) -> DataFrame:
    dim = data.next_dim(
        DIM_ALBUMS, data.albums(), data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS)
    )
    moved = scd2.reset_current_start(scd2.shift_closed_end(dim), feeds.NEXT_DATE)
    return moved.select("album_sk", "album_id", "eff_start_date", "eff_end_date", "is_current")


# -- dimensions ---------------------------------------------------------------------------


@query
def scd2_initial_artists(data: Data) -> DataFrame:
    return data.artists(feeds.ARTISTS_V1)


@query
def scd2_initial_albums(data: Data) -> DataFrame:
    return data.albums(feeds.ALBUMS_V1)


@query
def scd2_initial_again(data: Data) -> DataFrame:
    """The first-load form on a loaded dimension: changed albums are only closed."""
    first = data.albums()
    return scd2.scd2_apply(
        first,
        data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS),
        DIM_ALBUMS,
        SECOND,
        order_by=["album_id"],
        compare=DIM_ALBUMS.initial_compare,
        close_missing=False,
        reopen=False,
    ).table(scd2.closed_rows(first))


@query
def scd2_artists(data: Data) -> DataFrame:
    return data.next_dim(
        DIM_ARTISTS, data.artists(), data.delta(feeds.ARTISTS_V2_KEYED, ARTISTS)
    )


@query
def scd2_albums(data: Data) -> DataFrame:
    return data.next_dim(
        DIM_ALBUMS, data.albums(), data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS)
    )


@query
def scd2_albums_null_keys(data: Data) -> DataFrame:
    """A staged row without a key: no album counts as missing."""
    return data.next_dim(
        DIM_ALBUMS, data.albums(feeds.ALBUMS_V1), data.delta(feeds.ALBUMS_V2, ALBUMS)
    )


@query
def scd2_actions(data: Data) -> DataFrame:
    return scd2.scd2_actions(
        scd2.current_rows(data.albums()),
        data.stored_delta(feeds.ALBUMS_V2_KEYED, ALBUMS),
        "album_id",
        DIM_ALBUMS.attributes,
    )


@query
def dim_as_of(data: Data) -> DataFrame:
    """The customer version valid on each order's date."""
    orders = data.table("orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        F.to_date("o_orderdate").alias("o_date"),
    )
    versions = data.sql(feeds.CUSTOMER_VERSIONS).select(
        "c_custkey", "version_name", "eff_start_date", "eff_end_date"
    )
    return scd2.as_of(orders, versions, "c_custkey", "o_date")


# -- fact -----------------------------------------------------------------------------------


@query
def sk_lookup(data: Data) -> DataFrame:
    found = fact.lookup_keys(
        data.staged(feeds.SONGS_V1, SONGS), data.dims(), FACT_SONGS.lookups
    )
    return found.select("song_url", "artist_id", "artist_sk", "album_id", "album_sk")


@query
def fact_initial(data: Data) -> DataFrame:
    """The first-load merge run on a loaded table with the next snapshot."""
    dims = data.dims()
    return fact.fact_initial(
        data.fact(dims),
        stage_full(data.raw(feeds.SONGS_V2_KEYED, SONGS, feeds.NEXT_TS), SONGS, feeds.NEXT_TS),
        dims,
        FACT_SONGS,
        SECOND,
        order_by=["song_id"],
    ).table


def _fact_cycle(data: Data, new_songs: str) -> DataFrame:
    dims, staged = data.dims(), data.delta(new_songs, SONGS)
    before, artists, albums = side_by_side(
        data.spark,
        lambda: data.fact(dims),
        lambda: data.next_dim(
            DIM_ARTISTS, dims["dim_artists"], data.delta(feeds.ARTISTS_V2_KEYED, ARTISTS)
        ),
        lambda: data.next_dim(
            DIM_ALBUMS, dims["dim_albums"], data.delta(feeds.ALBUMS_V2_KEYED, ALBUMS)
        ),
    )
    after = {"dim_artists": artists, "dim_albums": albums}
    return fact.fact_apply(
        before, staged, after, FACT_SONGS, SECOND, order_by=["song_id"], stored=False
    ).table


@query
def fact_cycle(data: Data) -> DataFrame:
    return _fact_cycle(data, feeds.SONGS_V2_KEYED)


@query
def fact_cycle_null_keys(data: Data) -> DataFrame:
    """A staged song without a key: no fact row counts as gone."""
    return _fact_cycle(data, feeds.SONGS_V2)


@query
def soft_delete(data: Data) -> DataFrame:
    songs = data.numbered(data.songs(data.dims(), read=()), "is_valid")
    staged = data.delta(feeds.SONGS_V2_KEYED, SONGS)
    return fact.soft_delete(songs, staged, "song_id").select("song_sk", "song_id", "is_valid")


@query
def revalidate(data: Data) -> DataFrame:
    songs = data.numbered(data.songs(data.dims(), read=()), "is_valid")
    staged = data.delta(feeds.SONGS_V2_KEYED, SONGS)
    return fact.revalidate(songs, staged, "song_id").select("song_sk", "song_id", "is_valid")


# -- marts and reports ------------------------------------------------------------------------


def _star(data: Data):
    dims = data.dims()
    return data.songs(dims), dims["dim_artists"], dims["dim_albums"]


@query
def songs_enriched(data: Data) -> DataFrame:
    return marts.songs_enriched(*_star(data))


@query
def artist_summary(data: Data) -> DataFrame:
    return marts.artist_summary(*_star(data))


@query
def songs_per_artist(data: Data) -> DataFrame:
    return marts.songs_per_artist(marts.artist_summary(*_star(data)))


@query
def longest_songs(data: Data) -> DataFrame:
    return marts.longest_songs(marts.songs_enriched(*_star(data)))


@query
def albums_per_year(data: Data) -> DataFrame:
    return marts.albums_per_year(data.albums())


@query
def songs_per_month(data: Data) -> DataFrame:
    return marts.songs_per_month(data.songs(data.dims(), read=()))


# -- audit and checks ---------------------------------------------------------------------------


@query
def audit_summary(data: Data) -> DataFrame:
    return audit.audit_summary(data.sql(feeds.AUDIT))


@query
def audit_recent(data: Data) -> DataFrame:
    return audit.recent_steps(data.sql(feeds.AUDIT), EVENT_DAY, TASKS)


@query
def audit_log(data: Data) -> DataFrame:
    """The counts each step of a cycle reports."""
    staging = {
        "stg_songs": (feeds.SONGS_V1_KEYED, feeds.SONGS_V2_KEYED, SONGS),
        "stg_artists": (feeds.ARTISTS_V1_KEYED, feeds.ARTISTS_V2_KEYED, ARTISTS),
        "stg_albums": (feeds.ALBUMS_V1_KEYED, feeds.ALBUMS_V2_KEYED, ALBUMS),
    }
    *merged, dims = side_by_side(
        data.spark,
        *[
            lambda old=old, new=new, entity=entity: merge.snapshot_counts(
                data.staged(old, entity), data.delta(new, entity), entity.key
            )
            for old, new, entity in staging.values()
        ],
        data.dims,
    )
    merged = dict(zip(staging, merged))
    specs = (
        (DIM_ARTISTS, feeds.ARTISTS_V2_KEYED, ARTISTS),
        (DIM_ALBUMS, feeds.ALBUMS_V2_KEYED, ALBUMS),
    )
    applied = side_by_side(
        data.spark,
        *[
            lambda spec=spec, text=text, entity=entity: scd2.scd2_apply(
                dims[spec.table], data.stored_delta(text, entity), spec, SECOND, order_by=[spec.key]
            )
            for spec, text, entity in specs
        ],
    )
    results = {spec.table: r for (spec, _, _), r in zip(specs, applied)}
    counted = {t: audit.merge_counts(data.spark, counts) for t, (counts, _) in merged.items()}
    counted |= {t: audit.step_counts(r.changes, STEPS[t]) for t, r in results.items()}
    # The fact table holds a song as often as staging does, or less, unless a lookup repeats it.
    repeats = fact.lookups_fan_out(dims, FACT_SONGS.lookups)
    # Written are the columns that decide on a change.
    spec = replace(FACT_SONGS, attributes=FACT_SONGS.compare)
    natural = [k.natural for k in spec.lookups]
    told = [c for c in spec.compare if c not in [k.surrogate for k in spec.lookups]]
    blocks = fact.fact_blocks(
        materialize(data.songs(dims).select(spec.key, *spec.compare, "is_valid"), compression="zstd"),
        data.delta(feeds.SONGS_V2_KEYED, SONGS).select(spec.key, *natural, *told, "data_quality_flag"),
        {table: r.current for table, r in results.items()},
        spec,
        SECOND,
        stats=None if repeats else merged["stg_songs"][1],
        stored=False,
    )
    counted["fact_songs"] = audit.block_counts(data.spark, blocks, STEPS["fact_songs"])
    out = None
    for table, counts in counted.items():
        step = STEPS[table]
        one = counts.select(
            F.lit(step.task).alias("task_name"),
            F.lit(step.layer).alias("task_layer"),
            F.lit(step.operation).alias("operation"),
            F.lit(step.target).alias("target_table"),
            "rows_inserted",
            "rows_updated",
            "rows_deleted",
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def layer_counts(data: Data) -> DataFrame:
    dims = data.dims()
    songs, artists, albums = data.songs(dims, read=()), dims["dim_artists"], dims["dim_albums"]
    return checks.row_counts(
        {
            "DIM_ALBUMS": scd2.current_rows(albums),
            "DIM_ARTISTS": scd2.current_rows(artists),
            "FACT_SONGS": songs,
            "STG_ALBUMS": data.staged(feeds.ALBUMS_V1_KEYED, ALBUMS),
            "STG_ARTISTS": data.staged(feeds.ARTISTS_V1_KEYED, ARTISTS),
            "STG_SONGS": data.staged(feeds.SONGS_V1_KEYED, SONGS),
        },
        "tbl",
        "current_count",
    )


@query
def check_duplicates(data: Data) -> DataFrame:
    lines = data.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key")
    )
    return checks.duplicates(lines, "line_key")


@query
def check_orphans(data: Data) -> DataFrame:
    dims = data.dims()
    known = dims["dim_artists"].where(F.col("artist_sk") % 10 != 0)
    return checks.orphans(data.songs(dims, read=["artist_sk"]), known, "artist_sk").select("song_id", "artist_sk")


@query
def check_text_limits(data: Data) -> DataFrame:
    """Song texts over limits tight enough for these feeds to break them."""
    return checks.text_limits(data.raw(feeds.songs(), SONGS), feeds.TIGHT_LIMITS)


@query
def check_scd2_overlap(data: Data) -> DataFrame:
    versions = data.sql(feeds.CUSTOMER_VERSIONS).withColumn(
        "eff_end_date",
        F.when(F.col("c_custkey") % 9 == 0, F.date_add("eff_end_date", 40)).otherwise(
            F.col("eff_end_date")
        ),
    )
    return checks.overlaps(versions, "c_custkey", "version_sk")


QUERIES["quality_summary"] = QUERIES.pop("quality_summary_all")
