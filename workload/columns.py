"""Projections, filters, generators and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from discolake.functions import arrays, scalars
from discolake.operators import filters, generators, projection
from discolake.operators.joins import inherit
from discolake.plans import bronze
from discolake.sinks.topics import encode
from discolake.sources.documents import ORD
from workload.inputs import (
    ALBUMS_SQL,
    EVENTS_SQL,
    PLAYLISTS_SQL,
    TRACKS_SQL,
    event_messages,
    table,
)
from workload.registry import query
from workload.tables import CSV, albums, playlists, tracks

# Line items repeat (order, line), so scalar results carry the part as well.
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MS = "case when l_quantity = 13 then null else round(l_extendedprice * 100)::bigint end"


def lines_with_ms(spark, sf_dir):
    ms = F.round(F.col("l_extendedprice") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_COLUMNS, F.when(F.col("l_quantity") != 13, ms).alias("ms")
    )


@query(f"select {LINE}, {MS} / 1000.0::double as duration_sec from lineitem")
def duration_sec(spark, sf_dir):
    return lines_with_ms(spark, sf_dir).select(*LINE_COLUMNS, scalars.seconds(F.col("ms")).alias("duration_sec"))


@query(f"select {LINE}, coalesce({MS} / 60000.0::double, 0) as duration_min from lineitem")
def duration_min(spark, sf_dir):
    return lines_with_ms(spark, sf_dir).select(*LINE_COLUMNS, scalars.minutes(F.col("ms")).alias("duration_min"))


@query(f"select name, release_date as release_text, release_day as release_date from ({ALBUMS_SQL})")
def parse_release_date(spark, sf_dir):
    day = scalars.release_date(F.col("release_date"))
    return albums(spark, sf_dir).select(
        "name", F.col("release_date").alias("release_text"), day.alias("release_date")
    )


@query("select p_partkey, lower(p_type) as genre from part")
def genre_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalars.genre_key(F.col("p_type")).alias("genre"))


@query(f"""
    select snapshot_id, coalesce(owner_display_name, 'Unknown') as owner_name,
           coalesce(followers_total, 0) as followers
    from ({PLAYLISTS_SQL})
""")
def defaults(spark, sf_dir):
    return playlists(spark, sf_dir).select(
        "snapshot_id",
        scalars.with_default(F.col("owner.display_name"), "Unknown").alias("owner_name"),
        scalars.with_default(F.col("followers.total"), 0).alias("followers"),
    )


@query(f"""
    select name, case when artist_list is null then null else coalesce({CSV}, '') end as artist_ids
    from ({ALBUMS_SQL})
""")
def ids_to_csv(spark, sf_dir):
    return albums(spark, sf_dir).select("name", arrays.ids_to_csv(F.col("artists")).alias("artist_ids"))


@query(f"select name, genres from ({ALBUMS_SQL})")
def array_to_csv(spark, sf_dir):
    return albums(spark, sf_dir).select("name", arrays.values_to_csv(F.col("genres")).alias("genres"))


@query(f"select name, copyright_text_C, copyright_text_P from ({ALBUMS_SQL})")
def first_match_in_array(spark, sf_dir):
    notices = F.col("copyrights")
    return albums(spark, sf_dir).select(
        "name",
        arrays.first_where(notices, "type", "C", "text").alias("copyright_text_C"),
        arrays.first_where(notices, "type", "P", "text").alias("copyright_text_P"),
    )


@query(f"select name, artist_list[1] as first_artist from ({ALBUMS_SQL})")
def first_array_element(spark, sf_dir):
    return albums(spark, sf_dir).select("name", arrays.first_field(F.col("artists"), "id").alias("first_artist"))


@query(f"select snapshot_id, owner_id, owner_display_name, owner_type, followers_total from ({PLAYLISTS_SQL})")
def null_safe_struct(spark, sf_dir):
    return projection.select_renamed(
        playlists(spark, sf_dir),
        {
            "snapshot_id": "snapshot_id",
            "owner.id": "owner_id",
            "owner.display_name": "owner_display_name",
            "owner.type": "owner_type",
            "followers.total": "followers_total",
        },
    )


@query("select p_name, p_partkey, p_size from part")
def select_present(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return projection.select_present(part, ["p_name", "p_market", "p_partkey", "p_size"])


@query("select p_partkey, lower(p_type) as kind, null::varchar as genres from part")
def optional_column(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    part = projection.with_optional(part, "kind", "p_type", F.lower)
    part = projection.with_optional(part, "genres", "p_genres", arrays.values_to_csv)
    part = projection.with_optional(part, "seconds", "p_ms", scalars.seconds, missing=None)
    return part.drop("p_type")


WHOLE_LIST = "array_to_string(list_transform(coalesce(artist_list, []), lambda a: coalesce(a, '-')), ',')"


def whole_list(items):
    """All elements as one text; a null element is a dash."""
    return F.array_join(F.transform(items, lambda item: F.coalesce(item, F.lit("-"))), ",")


@query(f"""
    select id, name, album_type, type, total_tracks, release_date, label, popularity,
           {WHOLE_LIST} as artists, replace(coalesce(genres, ''), 'None', '-') as genres,
           copyright_text_C, copyright_text_P
    from ({ALBUMS_SQL})
""")
def prune_documents(spark, sf_dir):
    """Documents with further fields, cut down."""
    raw = albums(spark, sf_dir)
    artist = F.transform("artists", lambda a: F.struct(a["id"].alias("id"), F.lit("x").alias("uri")))
    raw = raw.withColumn("artists", artist).withColumn("available_markets", F.array(F.lit("VN")))
    pruned = bronze.prune_albums(raw)
    return pruned.select(
        "id", "name", "album_type", "type", "total_tracks", "release_date", "label", "popularity",
        whole_list(F.col("artists.id")).alias("artists"),
        whole_list(F.col("genres")).alias("genres"),
        arrays.first_where(F.col("copyrights"), "type", "C", "text").alias("copyright_text_C"),
        arrays.first_where(F.col("copyrights"), "type", "P", "text").alias("copyright_text_P"),
    )


@query(f"""
    select id, name, description, collaborative, public, owner_id, owner_display_name, owner_type,
           followers_total, null::varchar as href, primary_color, snapshot_id, type
    from ({PLAYLISTS_SQL})
""")
def prune_playlist_documents(spark, sf_dir):
    pruned = bronze.prune_playlists(playlists(spark, sf_dir))
    return pruned.select(
        "id", "name", "description", "collaborative", "public", F.col("owner.id").alias("owner_id"),
        F.col("owner.display_name").alias("owner_display_name"),
        F.col("owner.type").alias("owner_type"),
        F.col("followers.total").alias("followers_total"), F.col("followers.href").alias("href"),
        "primary_color", "snapshot_id", "type",
    )


@query(f"""
    select id, name, album_id, {WHOLE_LIST} as artists, disc_number, track_number, duration_ms, explicit,
           is_local, popularity, release_date, type
    from ({TRACKS_SQL})
""")
def prune_track_documents(spark, sf_dir):
    pruned = bronze.prune_tracks(tracks(spark, sf_dir))
    return pruned.select(
        "id", "name", F.col("album.id").alias("album_id"),
        whole_list(F.col("artists.id")).alias("artists"), "disc_number", "track_number",
        "duration_ms", "explicit", "is_local", "popularity", "release_date", "type",
    )


@query(f"""
    select {LINE}, o_orderpriority
    from lineitem left join (select * from orders where o_orderstatus <> 'P') on o_orderkey = l_orderkey
""")
def inherit_parent_attr(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    parents = parents.withColumnRenamed("o_orderkey", "l_orderkey")
    children = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return inherit(children, parents, "l_orderkey", "o_orderpriority")


@query(f"select id, name, album_id from ({TRACKS_SQL}) where id is not null and album_id is not null")
def dropna_keys(spark, sf_dir):
    flat = tracks(spark, sf_dir).select("id", "name", F.col("album.id").alias("album_id"))
    return filters.drop_missing(flat, ["id", "album_id"])


@query(f"""
    select snapshot_id, owner_id, owner_display_name from ({PLAYLISTS_SQL})
    where owner_id is not null and owner_id <> ''
""")
def truthy_guard(spark, sf_dir):
    kept = filters.with_truthy_id(playlists(spark, sf_dir), "owner")
    return kept.select(
        "snapshot_id", F.col("owner.id").alias("owner_id"),
        F.col("owner.display_name").alias("owner_display_name"),
    )


def playlist_items(spark, sf_dir):
    """Search results: some items are null, some lack an id or a name."""
    docs = playlists(spark, sf_dir)
    return docs.select(F.when(F.col("ord") % 17 != 3, F.struct("id", "name")).alias("item"), "ord")


@query(f"""
    select count(*) as items,
           count(*) filter (where ord % 17 = 3) as null_items,
           count(*) filter (where ord % 17 <> 3 and (id is null or name is null)) as incomplete_items,
           count(*) filter (where ord % 17 <> 3 and id is not null and name is not null) as kept_items
    from ({PLAYLISTS_SQL})
""")
def reject_counts(spark, sf_dir):
    return filters.reject_counts(playlist_items(spark, sf_dir), "item")


@query(f"""
    select id, name from ({PLAYLISTS_SQL})
    where ord % 17 <> 3 and id is not null and name is not null
""")
def usable_items(spark, sf_dir):
    return filters.usable_items(playlist_items(spark, sf_dir), "item").select("item.*")


@query("select p_partkey, unnest(string_split(replace(p_name, ' ', ','), ',')) as word from part")
def split_explode(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(",")).alias("csv"))
    return generators.split_explode(words, "csv", "word").drop("csv")


@query("""
    select p_brand as category, 0 as pos, 'p' || p_partkey as id, p_name as name, p_size::bigint as popularity
    from part where p_size % 5 <> 0
    union all
    select p_brand, 1, 'q' || p_partkey, p_name, p_size::bigint from part where p_size % 5 <> 0
""")
def flatten_category_map(spark, sf_dir):
    return bronze.flatten_categories(category_maps(spark, sf_dir))


@query("""
    select 'p' || p_partkey as id, p_name as name, p_size::bigint as popularity from part where p_size % 5 <> 0
    union all
    select 'q' || p_name, 'first of ' || p_partkey, p_size::bigint from part where p_size % 5 <> 0
    qualify row_number() over (partition by p_name order by p_partkey) = 1
""")
def artists_from_categories(spark, sf_dir):
    """An artist is listed under many categories, each time with other
    fields; the categories of a map are not in the order of their names."""
    return bronze.artists_from_categories(shared_maps(spark, sf_dir)).select("id", "name", "popularity")


def artist_struct(id_, name):
    return F.struct(id_.alias("id"), name.alias("name"), F.col("p_size").cast("long").alias("popularity"))


def category_maps(spark, sf_dir):
    """One map per part; every fifth size has an empty category."""
    pair = F.array(*(artist_struct(F.concat(F.lit(p), "p_partkey"), F.col("p_name")) for p in ("p", "q")))
    listed = F.when(F.col("p_size") % 5 != 0, pair).otherwise(F.slice(pair, 1, 0))
    return table(spark, sf_dir, "part").select(F.create_map("p_brand", listed).alias("categories"))


def shared_maps(spark, sf_dir):
    """One map per part with two categories, the later one first by name."""
    shared = F.concat(F.lit("q"), "p_name")
    own = artist_struct(F.concat(F.lit("p"), "p_partkey"), F.col("p_name"))
    first = F.array(own, artist_struct(shared, F.concat(F.lit("first of "), "p_partkey")))
    second = F.array(artist_struct(shared, F.concat(F.lit("second of "), "p_partkey")))
    empty = F.col("p_size") % 5 == 0
    maps = F.create_map(
        F.concat(F.lit("z "), "p_brand"), F.when(empty, F.slice(first, 1, 0)).otherwise(first),
        F.concat(F.lit("a "), "p_brand"), F.when(empty, F.slice(second, 1, 0)).otherwise(second),
    )
    return table(spark, sf_dir, "part").select(maps.alias("categories"), F.col("p_partkey").alias(ORD))


@query(f"select * from ({EVENTS_SQL}) where id is not null and id <> ''")
def event_normalize(spark, sf_dir):
    """Each event as a playlist answer with its own item and an empty one."""
    flat = event_messages(table(spark, sf_dir, "events"))
    track = F.struct(
        "id", "name", F.array(F.struct(F.col("artist").alias("name"))).alias("artists"),
        F.struct(F.col("album").alias("name"), "release_date").alias("album"),
        "duration_ms", "popularity",
    )
    empty = F.when(F.lit(False), F.struct(track.alias("track")))
    docs = flat.select(F.array(F.struct(track.alias("track")), empty).alias("items"), "timestamp")
    return bronze.normalize_events(docs, F.col("timestamp"))


@query(f"""
    select to_json({{id: id, name: name, artist: artist, album: album, release_date: release_date,
                     duration_ms: duration_ms, popularity: popularity, timestamp: timestamp}})::varchar as value
    from ({EVENTS_SQL})
""")
def event_encode(spark, sf_dir):
    return encode(event_messages(table(spark, sf_dir, "events")))


@query("""
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as stamp from events
""")
def iso_stamps(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", scalars.iso_text(F.col("ts")).alias("stamp"))
