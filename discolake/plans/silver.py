"""Silver tables: flat entity tables and many-to-many bridge tables.

Entity tables fold lists into comma strings.  Bridge tables hold one row per
link.  The two have names of their own and never share a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.functions.arrays import first_where, ids_to_csv, values_to_csv
from discolake.functions.scalars import release_date, seconds
from discolake.operators.filters import drop_missing
from discolake.operators.generators import explode_array
from discolake.operators.projection import select_present, select_renamed, with_optional
from discolake.operators.quality import require_columns


def tracks(docs: DataFrame) -> DataFrame:
    """One row per track; artist ids as a comma string."""
    require_columns(docs, ["album", "artists"], "tracks")
    flat = docs.withColumns(
        {"album_id": F.col("album.id"), "artist_ids": ids_to_csv(F.col("artists"))}
    )
    flat = with_optional(flat, "duration_sec", "duration_ms", seconds, missing=None)
    # The columns of the stored table, in their order.
    return select_present(
        flat,
        [
            "id", "name", "album_id", "artist_ids", "disc_number", "track_number",
            "duration_ms", "duration_sec", "explicit", "popularity", "release_date",
            "is_local", "type",
        ],
    )


def albums(docs: DataFrame) -> DataFrame:
    """One row per album; artist ids and genres as comma strings."""
    require_columns(docs, ["artists", "copyrights"], "albums")
    notices = F.col("copyrights")
    flat = docs.withColumns(
        {
            "artist_ids": ids_to_csv(F.col("artists")),
            "copyright_text_C": first_where(notices, "type", "C", "text"),
            "copyright_text_P": first_where(notices, "type", "P", "text"),
        }
    )
    flat = with_optional(flat, "genres", "genres", values_to_csv)
    # The columns of the stored table, in their order.
    return select_present(
        flat,
        [
            "id", "name", "album_type", "total_tracks", "release_date", "type",
            "artist_ids", "genres", "label", "popularity", "copyright_text_C",
            "copyright_text_P",
        ],
    ).withColumnRenamed("id", "album_id")


def artists(docs: DataFrame) -> DataFrame:
    """One row per artist; genres as a comma string."""
    require_columns(docs, ["followers"], "artists")
    flat = docs.withColumn("followers_total", F.col("followers.total"))
    flat = with_optional(flat, "genres", "genres", values_to_csv)
    return select_present(
        flat, ["id", "name", "genres", "followers_total", "popularity", "type"]
    ).withColumnRenamed("id", "artist_id")


def owners(docs: DataFrame) -> DataFrame:
    return select_present(docs, ["id", "display_name", "type"]).withColumnRenamed("id", "owner_id")


def playlists(docs: DataFrame) -> DataFrame:
    """One row per playlist; followers and owner flattened."""
    require_columns(docs, ["followers", "owner"], "playlists")
    flat = docs.withColumns(
        {
            "followers_total": F.col("followers.total"),
            "owner_id": F.col("owner.id"),
            "owner_display_name": F.col("owner.display_name"),
            "owner_type": F.col("owner.type"),
        }
    )
    return select_present(
        flat,
        [
            "id", "name", "description", "collaborative", "public", "followers_total",
            "owner_id", "owner_display_name", "owner_type", "primary_color",
            "snapshot_id", "type",
        ],
    ).withColumnRenamed("id", "playlist_id")


def album_artists(docs: DataFrame) -> DataFrame:
    """One row per album and artist; the release date as a date."""
    links = select_renamed(
        explode_array(docs, "artists", "artist"),
        {
            "id": "album_id",
            "name": "album_name",
            "popularity": "popularity",
            "release_date": "release_date",
            "total_tracks": "total_tracks",
            "artist.id": "artist_id",
        },
    )
    dated = links.withColumn("release_date", release_date(F.col("release_date")))
    return drop_missing(dated, ["album_id", "artist_id"])


def track_artists(docs: DataFrame) -> DataFrame:
    """One row per track and artist."""
    links = select_renamed(
        explode_array(docs, "artists", "artist"),
        {
            "id": "track_id",
            "name": "track_name",
            "popularity": "popularity",
            "duration_ms": "duration_ms",
            "explicit": "explicit",
            "track_number": "track_number",
            "album.id": "album_id",
            "artist.id": "artist_id",
        },
    )
    return drop_missing(links, ["track_id", "album_id", "artist_id"])


def artist_entities(docs: DataFrame) -> DataFrame:
    """One row per artist with an id; genres stay a list."""
    rows = select_renamed(
        docs,
        {
            "id": "artist_id",
            "name": "artist_name",
            "genres": "genres",
            "popularity": "popularity",
            "followers.total": "followers",
        },
    )
    return drop_missing(rows, ["artist_id"])


def owner_entities(docs: DataFrame) -> DataFrame:
    rows = select_renamed(docs, {"id": "owner_id", "display_name": "owner_name"})
    return drop_missing(rows, ["owner_id"])


def playlist_entities(docs: DataFrame) -> DataFrame:
    rows = select_renamed(
        docs,
        {
            "id": "playlist_id",
            "name": "playlist_name",
            "description": "description",
            "followers.total": "followers",
            "owner.id": "owner_id",
        },
    )
    return drop_missing(rows, ["playlist_id"])


# Table name -> transform of the documents of the same domain.
FLAT_TABLES = {
    "tracks": tracks,
    "albums": albums,
    "artists": artists,
    "owners": owners,
    "playlists": playlists,
}

# Table name -> (domain, transform).
LINK_TABLES = {
    "album_artists": ("albums", album_artists),
    "track_artists": ("tracks", track_artists),
    "artist_entities": ("artists", artist_entities),
    "owner_entities": ("owners", owner_entities),
    "playlist_entities": ("playlists", playlist_entities),
}
