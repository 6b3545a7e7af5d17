"""Shaping and landing of bronze documents."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from discolake.functions.arrays import first_field
from discolake.functions.scalars import iso_now, truthy
from discolake.operators.dedup import keep_first
from discolake.operators.filters import with_truthy_id
from discolake.operators.generators import flatten_map
from discolake.operators.quality import gate, presence
from discolake.sinks.staging import PACKED
from discolake.sinks.tables import replace_date
from discolake.sources.documents import ORD, element_texts, if_present


def _structs(array: str, *fields: str) -> Column:
    """An array of structs cut down to the given fields; a missing list is empty."""
    kept = F.transform(array, lambda item: F.struct(*[item[f].alias(f) for f in fields]))
    return F.coalesce(kept, F.array())


def _struct(path: str, *fields: str) -> Column:
    """A struct cut down to the given fields; a missing one has null fields."""
    return F.struct(*[F.col(f"{path}.{f}").alias(f) for f in fields])


def prune_albums(raw: DataFrame) -> DataFrame:
    return raw.select(
        "album_type", "total_tracks", "id", "name", "release_date", "type",
        _structs("artists", "id").alias("artists"),
        _structs("copyrights", "text", "type").alias("copyrights"),
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
        "label", "popularity",
    )


def prune_tracks(raw: DataFrame) -> DataFrame:
    """``release_date`` is the one inherited from the album (see ``inherit``)."""
    return raw.select(
        _struct("album", "id").alias("album"),
        _structs("artists", "id").alias("artists"),
        "disc_number", "duration_ms", "explicit", "release_date", "id", "is_local",
        "name", "popularity", "track_number", "type",
    )


def prune_playlists(raw: DataFrame) -> DataFrame:
    return raw.select(
        "collaborative", "description",
        _struct("followers", "href", "total").alias("followers"),
        "id", "name",
        _struct("owner", "display_name", "id", "type").alias("owner"),
        "primary_color", "public", "snapshot_id", "type",
    )


def owners_from_playlists(playlists: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first owner struct of each non-empty owner id."""
    owned = with_truthy_id(playlists, "owner")
    return keep_first(owned, "owner.id", order).select("owner.*")


def flatten_categories(categories: DataFrame, column: str = "categories") -> DataFrame:
    """One row per category and artist, with the position in the category."""
    return flatten_map(categories, column).drop("entry")


def artists_from_categories(categories: DataFrame, column: str = "categories") -> DataFrame:
    """The flat artist documents of a category map, one per id.

    An artist under several categories is taken from the first in the file:
    by ``ord``, the place of the map, where there is one, then by the place
    of the category in the map and of the artist in the category.
    """
    place = [ORD] if ORD in categories.columns else []
    flat = flatten_map(categories, column, keep=place)
    order = [*place, "entry", "pos"]
    kept = keep_first(flat.where(truthy(F.col("id"))), "id", order)
    return kept.drop(*order, "category")


def normalize_events(docs: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Playlist items to flat events; items without a track id are dropped.

    An event without artists has a null artist.  ``stamp`` is the event time
    as text and defaults to now.
    """
    stamped = docs.withColumn("_stamp", iso_now() if stamp is None else stamp)
    items = stamped.select(F.explode("items.track").alias("track"), "_stamp")
    return items.where(truthy(F.col("track.id"))).select(
        F.col("track.id").alias("id"),
        F.col("track.name").alias("name"),
        first_field(F.col("track.artists"), "name").alias("artist"),
        F.col("track.album.name").alias("album"),
        F.col("track.album.release_date").alias("release_date"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("track.popularity").alias("popularity"),
        F.col("_stamp").alias("timestamp"),
    )


# The crawl output expected before landing, table -> file.
EXPECTED_FILES = {
    "albums": "albums.json",
    "albums_manifest": "albums_processing_metadata.json",
    "artists": "artists.json",
    "owners": "owners.json",
    "playlists": "playlists.json",
    "playlists_manifest": "playlists_processing_metadata.json",
    "tracks": "tracks.json",
    "tracks_manifest": "tracks_processing_metadata.json",
}


def crawl_output(
    spark: SparkSession, source: str, layout: str = "indented", lines: Collection[str] = ()
) -> dict[str, DataFrame | None]:
    """The expected datasets of a crawl as JSON texts; None where missing.

    The tables named in ``lines`` have one document per line, such as owners
    and artists that Spark has derived; the others have ``layout``.  The
    lines of a manifest, whose key list may be long, are landed as they are.
    """
    found = {}
    for table, file in EXPECTED_FILES.items():
        path = f"{source}/{file}"
        if table.endswith("_manifest"):
            written = if_present(spark.read.text, path)
            found[table] = None if written is None else written.where(F.trim("value") != "")
        else:
            found[table] = if_present(element_texts, spark, path, "lines" if table in lines else layout)
    return found


def land(
    spark: SparkSession,
    source: str,
    bronze: str,
    ingest_date: str,
    layout: str = "indented",
    gated: bool = True,
    lines: Collection[str] = (),
) -> dict[str, int | None]:
    """Land the crawl output under ``<table>/ingest_date=<date>/``.

    Documents of the layouts ``indented`` and ``lines`` are landed unparsed,
    one per line, so that nothing is lost, in packed files of so many lines that later scans can share.
    Those of ``array`` are parsed and written anew; see ``sources.documents``.
    With ``gated`` nothing is landed unless
    every expected dataset has rows; without, a missing one is skipped and
    reported as None.
    """
    found = crawl_output(spark, source, layout, lines)
    if gated:
        gate(presence(spark, found))
    return {
        table: None
        if texts is None
        else replace_date(texts, f"{bronze}/{table}", ingest_date, format="text", options=PACKED)
        for table, texts in found.items()
    }
