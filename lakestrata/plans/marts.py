"""Marts over the star schema, and the analytic queries on them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.scalar import duration_text, month_start
from lakestrata.operators.keyed import broadcast_small
from lakestrata.operators.scd2 import current_rows


ARTIST = ("artist_name", "external_url")
ALBUM = ("album_name", "album_release_date", "album_total_tracks", "release_year", "album_url")


def _star(
    fact: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    of_artist: Sequence[str] = ARTIST,
    of_album: Sequence[str] = ALBUM,
) -> DataFrame:
    """Valid facts with these values of their current artist and album.

    A dimension measured to be small is broadcast; else Spark shuffles, and adaptive
    execution splits a hot artist or album.
    """
    artists = current_rows(artists).select("artist_sk", *of_artist)
    albums = current_rows(albums).select("album_sk", *of_album)
    return (
        fact.where(F.col("is_valid"))
        .join(broadcast_small(artists), "artist_sk")
        .join(broadcast_small(albums), "album_sk")
    )


def songs_enriched(fact: DataFrame, artists: DataFrame, albums: DataFrame) -> DataFrame:
    return _star(fact, artists, albums).select(
        "song_id",
        "song_name",
        duration_text("duration_minutes", "duration_seconds").alias("song_duration_formatted"),
        "song_duration_ms",
        "song_added_date",
        "song_url",
        "artist_name",
        F.col("external_url").alias("artist_url"),
        "album_name",
        "album_release_date",
        "album_total_tracks",
        "release_year",
        "album_url",
    )


def artist_summary(fact: DataFrame, artists: DataFrame, albums: DataFrame) -> DataFrame:
    """Figures per artist name; namesakes share a row.

    An album's track count is added once per song of it.  Both distinct counts are
    grouped by the counted value before the artist, so a hot artist is spread.
    """
    return (
        _star(
            fact, artists, albums, ("artist_name",), ("album_release_date", "album_total_tracks")
        )
        .groupBy("artist_name")
        .agg(
            F.count_distinct("song_id").alias("total_songs"),
            F.count_distinct("album_sk").alias("total_albums"),
            F.round(F.avg("song_duration_ms") / 1000, 0).alias("avg_song_duration_sec"),
            F.min("album_release_date").alias("earliest_album"),
            F.max("album_release_date").alias("latest_album"),
            F.sum("album_total_tracks").alias("total_tracks_across_albums"),
        )
    )


def songs_per_artist(summary: DataFrame) -> DataFrame:
    return summary.select("artist_name", "total_songs", "total_albums").orderBy(
        F.desc_nulls_first("total_songs"), F.asc_nulls_last("artist_name")
    )


def longest_songs(enriched: DataFrame, n: int = 10) -> DataFrame:
    """The n longest; ties go to the smaller song id."""
    return (
        enriched.orderBy(F.desc_nulls_first("song_duration_ms"), F.asc_nulls_last("song_id"))
        .limit(n)
        .select("song_name", "artist_name", "song_duration_formatted")
    )


def albums_per_year(albums: DataFrame) -> DataFrame:
    return (
        current_rows(albums)
        .groupBy("release_year")
        .agg(F.count(F.lit(1)).alias("albums_released"))
        .orderBy(F.desc_nulls_first("release_year"))
    )


def songs_per_month(fact: DataFrame) -> DataFrame:
    """All songs, also those no longer valid."""
    return (
        fact.groupBy(month_start("song_added_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("songs_added"))
        .orderBy(F.desc_nulls_first("month"))
    )


def is_stale(
    refreshed: datetime | None, now: datetime, lag: timedelta = timedelta(hours=1)
) -> bool:
    """Whether a mart is older than it may be."""
    return refreshed is None or now - refreshed > lag


def latest_load(df: DataFrame) -> DataFrame:
    """Rows of the most recent load."""
    newest = df.agg(F.max("_load_timestamp")).scalar()
    return df.where(F.col("_load_timestamp") == newest)
