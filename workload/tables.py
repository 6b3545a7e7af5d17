"""Silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from discolake.plans import gold, silver
from workload.inputs import (
    ALBUMS_SQL,
    ARTISTS_SQL,
    OWNERS_SQL,
    PLAYLISTS_SQL,
    TRACKS_SQL,
    customer_owners,
    lineitem_tracks,
    order_albums,
    order_playlists,
    supplier_artists,
    table,
)
from workload.registry import query

# A null id inside a list is skipped; an empty list gives ''.
CSV = "array_to_string(list_filter(artist_list, lambda a: a is not null), ',')"

SILVER_TRACKS = f"""
    select id, name, album_id,
           case when artist_list is null then null else coalesce({CSV}, '') end as artist_ids,
           disc_number, track_number, duration_ms, duration_ms / 1000.0::double as duration_sec,
           explicit, popularity, release_date, is_local, type
    from ({TRACKS_SQL})
"""

SILVER_ALBUMS = f"""
    select id as album_id, name, album_type, total_tracks, release_date, type,
           case when artist_list is null then null else coalesce({CSV}, '') end as artist_ids,
           genres, label, popularity, copyright_text_C, copyright_text_P
    from ({ALBUMS_SQL})
"""

SILVER_ARTISTS = f"""
    select id as artist_id, name, genres, followers_total, popularity, type from ({ARTISTS_SQL})
"""


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_tracks(table(spark, sf_dir, "lineitem"))


def albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_albums(table(spark, sf_dir, "orders"))


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_artists(table(spark, sf_dir, "supplier"))


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_playlists(table(spark, sf_dir, "orders"))


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_owners(table(spark, sf_dir, "customer"))


@query(SILVER_TRACKS)
def silver_tracks(spark, sf_dir):
    return silver.tracks(tracks(spark, sf_dir))


@query(SILVER_ALBUMS)
def silver_albums(spark, sf_dir):
    return silver.albums(albums(spark, sf_dir))


@query(SILVER_ARTISTS)
def silver_artists(spark, sf_dir):
    return silver.artists(artists(spark, sf_dir))


@query(f"select id as owner_id, display_name, type from ({OWNERS_SQL})")
def silver_owners(spark, sf_dir):
    return silver.owners(owners(spark, sf_dir))


@query(f"""
    select id as playlist_id, name, description, collaborative, public, followers_total, owner_id,
           owner_display_name, owner_type, primary_color, snapshot_id, type
    from ({PLAYLISTS_SQL})
""")
def silver_playlists(spark, sf_dir):
    return silver.playlists(playlists(spark, sf_dir))


@query(f"""
    select id as artist_id, name as artist_name,
           genres, popularity, followers_total as followers
    from ({ARTISTS_SQL}) where id is not null
""")
def silver_artists_b(spark, sf_dir):
    """The genre list is shown as one text; a null list stays null."""
    rows = silver.artist_entities(artists(spark, sf_dir))
    return rows.withColumn("genres", F.array_join("genres", ",", "None"))


@query(f"select id as owner_id, display_name as owner_name from ({OWNERS_SQL}) where id is not null")
def silver_owners_b(spark, sf_dir):
    return silver.owner_entities(owners(spark, sf_dir))


@query(f"""
    select id as playlist_id, name as playlist_name, description, followers_total as followers, owner_id
    from ({PLAYLISTS_SQL}) where id is not null
""")
def silver_playlists_b(spark, sf_dir):
    return silver.playlist_entities(playlists(spark, sf_dir))


@query(f"""
    select track_id, track_name, popularity, duration_ms, explicit, track_number, album_id, artist_id
    from (select id as track_id, name as track_name, popularity, duration_ms, explicit, track_number,
                 album_id, unnest(artist_list) as artist_id
          from ({TRACKS_SQL}))
    where track_id is not null and album_id is not null and artist_id is not null
""")
def bridge_track_artists(spark, sf_dir):
    return silver.track_artists(tracks(spark, sf_dir))


@query(f"""
    select album_id, album_name, popularity, release_date, total_tracks, artist_id
    from (select id as album_id, name as album_name, popularity, release_day as release_date,
                 total_tracks, unnest(artist_list) as artist_id
          from ({ALBUMS_SQL}))
    where album_id is not null and artist_id is not null
""")
def bridge_album_artists(spark, sf_dir):
    return silver.album_artists(albums(spark, sf_dir))


GOLD_ALBUMS = f"""
    select g.album_id, track_count_in_tracks, avg_track_popularity, total_duration_sec,
           a.name as album_name, a.album_type, a.total_tracks, a.release_date, a.artist_ids,
           a.genres, a.label, a.popularity as album_popularity
    from (select album_id, count(id) as track_count_in_tracks,
                 avg(popularity) as avg_track_popularity,
                 coalesce(sum(duration_ms), 0)::double / 1000.0 as total_duration_sec
          from ({SILVER_TRACKS}) where album_id is not null group by album_id) g
    left join ({SILVER_ALBUMS}) a on a.album_id = g.album_id
"""

GOLD_ARTISTS = f"""
    select g.artist_id, track_count, avg_track_popularity, max_track_popularity,
           a.name as artist_name, a.genres, a.followers_total, a.popularity as artist_popularity
    from (select artist_id, count(id) as track_count, avg(popularity) as avg_track_popularity,
                 max(popularity) as max_track_popularity
          from (select id, popularity, unnest(string_split(artist_ids, ',')) as artist_id
                from ({SILVER_TRACKS}) where artist_ids is not null)
          group by artist_id) g
    left join ({SILVER_ARTISTS}) a on a.artist_id = g.artist_id
"""


@query(GOLD_ALBUMS)
def gold_albums_stats(spark, sf_dir):
    return gold.albums_stats(silver_tracks(spark, sf_dir), silver_albums(spark, sf_dir))


@query(GOLD_ALBUMS)
def gold_albums_stats_any_keys(spark, sf_dir):
    """The same, with joins that stay split whatever keys the albums repeat."""
    return gold.albums_stats(silver_tracks(spark, sf_dir), silver_albums(spark, sf_dir), hot=None)


@query(GOLD_ARTISTS)
def gold_artists_stats(spark, sf_dir):
    return gold.artists_stats(silver_tracks(spark, sf_dir), silver_artists(spark, sf_dir))


@query(f"""
    {GOLD_ALBUMS}
    order by track_count_in_tracks desc, avg_track_popularity desc nulls last, g.album_id
""")
def gold_ranked_albums(spark, sf_dir):
    return gold.ranked_albums(gold_albums_stats(spark, sf_dir))


@query(f"""
    {GOLD_ARTISTS}
    order by track_count desc, avg_track_popularity desc nulls last, g.artist_id
""")
def gold_ranked_artists(spark, sf_dir):
    return gold.ranked_artists(gold_artists_stats(spark, sf_dir))
