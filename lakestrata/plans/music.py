"""The song, artist and album feeds and the star schema over them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import Dimension, Entity, Fact, Lookup, Model
from lakestrata.functions.scalar import (
    leftover_seconds,
    try_date,
    try_date_auto,
    try_number,
    try_timestamp_auto,
    whole_minutes,
)
from lakestrata.operators.audit import Step
from lakestrata.plans.marts import artist_summary, songs_enriched


def _missing(column):
    return lambda: F.col(column).isNull()


def _parse_songs():
    return {
        "_millis": try_number("song_duration"),
        "_added": try_timestamp_auto("song_added"),
    }


def _songs():
    return [
        F.trim("song_id").alias("song_id"),
        F.trim("song_name").alias("song_name"),
        F.col("_millis").alias("song_duration_ms"),
        whole_minutes("_millis").alias("duration_minutes"),
        leftover_seconds("_millis").alias("duration_seconds"),
        F.trim("song_url").alias("song_url"),
        F.col("_added").alias("song_added_timestamp"),
        F.to_date("_added").alias("song_added_date"),
        F.trim("album_id").alias("album_id"),
        F.trim("artist_id").alias("artist_id"),
    ]


def _artists():
    return [F.trim(c).alias(c) for c in ("artist_id", "artist_name", "external_url")]


def _parse_albums():
    """The value takes one format, the rule any known one: a row can be valid
    without a date."""
    return {
        "_released": try_date("album_release_date", "yyyy-MM-dd"),
        "_any_date": try_date_auto("album_release_date"),
    }


def _parse_albums_delta():
    found = try_date_auto("album_release_date")
    return {"_released": found, "_any_date": found}


def _albums():
    return [
        F.trim("album_id").alias("album_id"),
        F.trim("album_name").alias("album_name"),
        F.col("_released").alias("album_release_date"),
        try_number("album_total_tracks").alias("album_total_tracks"),
        F.trim("album_url").alias("album_url"),
        F.year("_released").alias("release_year"),
    ]


# Flags.  The full build and the per-batch build name some of them
# differently and do not test the same things; both are kept as they are.
SONGS = Entity(
    name="songs",
    key="song_id",
    columns=(
        "song_id",
        "song_name",
        "song_duration",
        "song_url",
        "song_added",
        "album_id",
        "artist_id",
    ),
    parse=_parse_songs,
    project=_songs,
    rules=(
        ("MISSING_SONG_ID", _missing("song_id")),
        ("INVALID_DURATION", _missing("_millis")),
        ("INVALID_DATE", _missing("_added")),
        ("MISSING_ALBUM_ID", _missing("album_id")),
        ("MISSING_ARTIST_ID", _missing("artist_id")),
    ),
    delta_parse=_parse_songs,
    delta_rules=(
        ("MISSING_SONG_ID", _missing("song_id")),
        ("INVALID_DURATION", _missing("_millis")),
    ),
    limits={
        "song_id": 100,
        "song_name": 500,
        "song_duration": 20,
        "song_url": 1000,
        "song_added": 100,
        "album_id": 100,
        "artist_id": 100,
    },
)

ARTISTS = Entity(
    name="artists",
    key="artist_id",
    columns=("artist_id", "artist_name", "external_url"),
    parse=dict,
    project=_artists,
    rules=(
        ("MISSING_ARTIST_ID", _missing("artist_id")),
        ("MISSING_NAME", _missing("artist_name")),
    ),
    delta_parse=dict,
    delta_rules=(
        ("MISSING_ARTIST_ID", _missing("artist_id")),
        ("MISSING_ARTIST_NAME", _missing("artist_name")),
    ),
    limits={"artist_id": 100, "artist_name": 500, "external_url": 1000},
)

ALBUMS = Entity(
    name="albums",
    key="album_id",
    columns=(
        "album_id",
        "album_name",
        "album_release_date",
        "album_total_tracks",
        "album_url",
    ),
    parse=_parse_albums,
    project=_albums,
    rules=(
        ("MISSING_ALBUM_ID", _missing("album_id")),
        ("INVALID_DATE", _missing("_any_date")),
    ),
    delta_parse=_parse_albums_delta,
    delta_rules=(
        ("MISSING_ALBUM_ID", _missing("album_id")),
        ("INVALID_RELEASE_DATE", _missing("_any_date")),
    ),
    limits={
        "album_id": 100,
        "album_name": 500,
        "album_release_date": 50,
        "album_total_tracks": 10,
        "album_url": 1000,
    },
)

ENTITIES = (SONGS, ARTISTS, ALBUMS)

DIM_ARTISTS = Dimension(
    name="artists",
    key="artist_id",
    surrogate="artist_sk",
    attributes=("artist_name", "external_url"),
    compare=("artist_name", "external_url"),
    initial_compare=("artist_name", "external_url"),
)

DIM_ALBUMS = Dimension(
    name="albums",
    key="album_id",
    surrogate="album_sk",
    attributes=(
        "album_name",
        "album_release_date",
        "album_total_tracks",
        "album_url",
        "release_year",
    ),
    compare=("album_name", "album_release_date", "album_total_tracks", "album_url"),
    initial_compare=("album_name", "album_total_tracks"),
)

FACT_SONGS = Fact(
    name="songs",
    key="song_id",
    surrogate="song_sk",
    lookups=(Lookup(DIM_ARTISTS), Lookup(DIM_ALBUMS)),
    attributes=(
        "artist_sk",
        "album_sk",
        "song_name",
        "song_duration_ms",
        "duration_minutes",
        "duration_seconds",
        "song_url",
        "song_added_timestamp",
        "song_added_date",
    ),
    compare=(
        "artist_sk",
        "album_sk",
        "song_name",
        "song_duration_ms",
        "song_url",
        "song_added_timestamp",
    ),
    initial_compare=("song_name",),
    initial_update=("song_name",),
)

_NUMBER = T.DecimalType(38, 0)
_VERSION = [
    T.StructField("eff_start_date", T.DateType()),
    T.StructField("eff_end_date", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
]
_STAGED = [
    T.StructField("data_quality_flag", T.StringType()),
    T.StructField("_load_timestamp", T.TimestampNTZType()),
    T.StructField("_transform_timestamp", T.TimestampNTZType()),
]
_SONG_VALUES = [
    T.StructField("song_name", T.StringType()),
    T.StructField("song_duration_ms", _NUMBER),
    T.StructField("duration_minutes", _NUMBER),
    T.StructField("duration_seconds", _NUMBER),
    T.StructField("song_url", T.StringType()),
    T.StructField("song_added_timestamp", T.TimestampNTZType()),
    T.StructField("song_added_date", T.DateType()),
]
_ALBUM_VALUES = [
    T.StructField("album_name", T.StringType()),
    T.StructField("album_release_date", T.DateType()),
    T.StructField("album_total_tracks", _NUMBER),
    T.StructField("album_url", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
]

SCHEMAS = {
    "stg_songs": T.StructType(
        [
            T.StructField("song_id", T.StringType()),
            *_SONG_VALUES,
            T.StructField("album_id", T.StringType()),
            T.StructField("artist_id", T.StringType()),
            *_STAGED,
        ]
    ),
    "stg_artists": T.StructType(
        [
            T.StructField("artist_id", T.StringType()),
            T.StructField("artist_name", T.StringType()),
            T.StructField("external_url", T.StringType()),
            *_STAGED,
        ]
    ),
    "stg_albums": T.StructType(
        [T.StructField("album_id", T.StringType()), *_ALBUM_VALUES, *_STAGED]
    ),
    "dim_artists": T.StructType(
        [
            T.StructField("artist_sk", T.LongType()),
            T.StructField("artist_id", T.StringType()),
            T.StructField("artist_name", T.StringType()),
            T.StructField("external_url", T.StringType()),
            *_VERSION,
        ]
    ),
    "dim_albums": T.StructType(
        [
            T.StructField("album_sk", T.LongType()),
            T.StructField("album_id", T.StringType()),
            *_ALBUM_VALUES,
            *_VERSION,
        ]
    ),
    "fact_songs": T.StructType(
        [
            T.StructField("song_sk", T.LongType()),
            T.StructField("song_id", T.StringType()),
            T.StructField("artist_sk", T.LongType()),
            T.StructField("album_sk", T.LongType()),
            *_SONG_VALUES,
            T.StructField("_load_timestamp", T.TimestampNTZType()),
            T.StructField("_source_file", T.StringType()),
            T.StructField("is_valid", T.BooleanType()),
        ]
    ),
}

# Step names in the audit log.
STEPS = {
    "stg_songs": Step("TASK_LOAD_STAGING_SONGS", "STAGING", "MERGE+DELETE", "STG_SONGS"),
    "stg_artists": Step("TASK_LOAD_STAGING_ARTISTS", "STAGING", "MERGE+DELETE", "STG_ARTISTS"),
    "stg_albums": Step("TASK_LOAD_STAGING_ALBUMS", "STAGING", "MERGE+DELETE", "STG_ALBUMS"),
    "dim_artists": Step(
        "TASK_LOAD_DIMENSIONS_ARTISTS", "WAREHOUSE", "SCD2_MERGE+INSERT", "DIM_ARTISTS"
    ),
    "dim_albums": Step(
        "TASK_LOAD_DIMENSIONS_ALBUMS", "WAREHOUSE", "SCD2_MERGE+INSERT", "DIM_ALBUMS"
    ),
    "fact_songs": Step("TASK_LOAD_FACTS", "WAREHOUSE", "MERGE+SOFT_DELETE", "FACT_SONGS"),
    "raw_songs": Step("TASK_REFRESH_PIPE_SONGS", "RAW", "PIPE_REFRESH", "RAW_SONGS"),
    "raw_artists": Step("TASK_REFRESH_PIPE_ARTISTS", "RAW", "PIPE_REFRESH", "RAW_ARTISTS"),
    "raw_albums": Step("TASK_REFRESH_PIPE_ALBUMS", "RAW", "PIPE_REFRESH", "RAW_ALBUMS"),
}

MODEL = Model(
    entities=ENTITIES,
    dimensions=(DIM_ARTISTS, DIM_ALBUMS),
    fact=FACT_SONGS,
    schemas=SCHEMAS,
    steps=STEPS,
    marts={"songs_enriched": songs_enriched, "artist_summary": artist_summary},
)
