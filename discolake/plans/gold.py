"""Gold statistics per artist and per album.

Rows are grouped before the join, so the join sees one row per key, and each
group is combined on the map side, so a key with very many tracks costs one
row per task.  The stored tables are not sorted; the ranked views are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.operators.filters import drop_missing
from discolake.operators.generators import split_explode
from discolake.operators.joins import attach
from discolake.operators.projection import select_renamed
from discolake.operators.quality import require_columns
from discolake.operators.ranking import ranked

# The columns of the stored tables, in their order, and what they are made of.
ARTIST_ATTRIBUTES = {
    "artist_id": "artist_id",
    "name": "artist_name",
    "genres": "genres",
    "followers_total": "followers_total",
    "popularity": "artist_popularity",
}

ALBUM_ATTRIBUTES = {
    "album_id": "album_id",
    "name": "album_name",
    "album_type": "album_type",
    "total_tracks": "total_tracks",
    "release_date": "release_date",
    "artist_ids": "artist_ids",
    "genres": "genres",
    "label": "label",
    "popularity": "album_popularity",
}


def artist_groups(tracks: DataFrame) -> DataFrame:
    """Per artist id in the comma lists: tracks, mean and highest popularity.

    A null list has no artists; exploding it gives no rows.
    """
    require_columns(tracks, ["artist_ids"], "tracks")
    listed = tracks.select("id", "popularity", "artist_ids")
    return (
        split_explode(listed, "artist_ids", "artist_id")
        .groupBy("artist_id")
        .agg(
            F.count("id").alias("track_count"),
            F.avg("popularity").alias("avg_track_popularity"),
            F.max("popularity").alias("max_track_popularity"),
        )
    )


def album_groups(tracks: DataFrame) -> DataFrame:
    """Per album id: tracks, mean popularity, seconds in all.

    Whole milliseconds are summed and divided once, so the total does not
    depend on the order of the rows.  An album without any duration has zero.
    """
    require_columns(tracks, ["album_id", "duration_ms"], "tracks")
    total_ms = F.coalesce(F.sum("duration_ms"), F.lit(0))
    return (
        drop_missing(tracks, ["album_id"])
        .groupBy("album_id")
        .agg(
            F.count("id").alias("track_count_in_tracks"),
            F.avg("popularity").alias("avg_track_popularity"),
            (total_ms / F.lit(1000.0)).alias("total_duration_sec"),
        )
    )


def artists_stats(tracks: DataFrame, artists: DataFrame, hot: Sequence[str] | None = ()) -> DataFrame:
    """``hot`` as in ``attach``; None for artists that may have very many rows of one id."""
    return attach(artist_groups(tracks), select_renamed(artists, ARTIST_ATTRIBUTES), "artist_id", hot)


def albums_stats(tracks: DataFrame, albums: DataFrame, hot: Sequence[str] | None = ()) -> DataFrame:
    """``hot`` as in ``attach``; None for albums that may have very many rows of one id."""
    return attach(album_groups(tracks), select_renamed(albums, ALBUM_ATTRIBUTES), "album_id", hot)


def ranked_artists(stats: DataFrame) -> DataFrame:
    """Most tracks first, then most popular."""
    return ranked(stats, ["track_count", "avg_track_popularity"], "artist_id")


def ranked_albums(stats: DataFrame) -> DataFrame:
    """Most tracks first, then most popular."""
    return ranked(stats, ["track_count_in_tracks", "avg_track_popularity"], "album_id")


# Table name -> (transform, silver tables it reads).
TABLES = {
    "artists_stats": (artists_stats, ("tracks", "artists")),
    "albums_stats": (albums_stats, ("tracks", "albums")),
}
