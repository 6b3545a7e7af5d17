"""Sources, sinks and streams: data is written, then read back."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.operators.dedup import keep_first
from discolake.operators.quality import require_columns
from discolake.plans import bronze, silver
from discolake.plans.layers import METRICS, LayerFailed, build_links, build_silver
from discolake.schemas import ALBUM, DOCUMENTS, OWNER, TRACK
from discolake.session import new_folder
from discolake.sinks.exports import CSV, export_csv, export_tables, write_documents
from discolake.sinks.staging import PACKED, discard
from discolake.sinks.tables import overwrite, overwrite_by_year, replace_date
from discolake.sinks.topics import encode
from discolake.sources.documents import read_category_map, read_documents, read_domain, read_stored
from discolake.sources.tables import read_date
from discolake.streaming import events as event_stream
from workload.inputs import (
    ALBUMS_SQL,
    EVENTS_SQL,
    OWNERS_SQL,
    PLAYLISTS_SQL,
    event_messages,
    table,
)
from workload.registry import query
from workload.tables import (
    GOLD_ALBUMS,
    GOLD_ARTISTS,
    SILVER_ALBUMS,
    SILVER_ARTISTS,
    SILVER_TRACKS,
    albums,
    artists,
    bridge_album_artists,
    gold_albums_stats,
    gold_artists_stats,
    owners,
    playlists,
    silver_tracks,
    tracks,
)

# Documents per written array file; files grow in number with the data.
CHUNK = 2000


def write_array_files(docs, key, folder, indented):
    """Documents as JSON array files of at most CHUNK documents each."""
    text = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    if indented:
        body = F.substring(text, F.lit(2), F.length(text) - 2)
        text = F.concat(F.lit("  {\n    "), body, F.lit("\n  }"))
    chunks = docs.groupBy(F.floor(key / CHUNK).alias("chunk"))
    listed = chunks.agg(F.array_join(F.collect_list(text), ",\n").alias("list"))
    array = F.concat(F.lit("[\n"), "list", F.lit("\n]"))
    listed.select("chunk", array.alias("value")).write.partitionBy("chunk").text(folder)
    return f"{folder}/chunk=*"


def owner_files(spark, sf_dir, indented):
    customer = table(spark, sf_dir, "customer")
    docs = customer.selectExpr(
        "c_custkey",
        "c_name as display_name",
        "case when c_custkey % 29 = 5 then null else cast(c_custkey as string) end as id",
        "'user' as type",
    )
    return write_array_files(docs, F.col("c_custkey"), new_folder(spark, "owners"), indented)


@query(OWNERS_SQL)
def scan_json_array(spark, sf_dir):
    return read_documents(spark, owner_files(spark, sf_dir, False), OWNER, "array")


@query(OWNERS_SQL)
def scan_json_array_indented(spark, sf_dir):
    """The same array files, cut between their elements while reading."""
    return read_documents(spark, owner_files(spark, sf_dir, True), OWNER, "indented")


@query(OWNERS_SQL)
def scan_json_array_any(spark, sf_dir):
    """Array files without line breaks, cut at their braces while reading."""
    customer = table(spark, sf_dir, "customer")
    doc = F.to_json(F.struct(
        F.col("c_name").alias("display_name"),
        F.when(F.col("c_custkey") % 29 != 5, F.col("c_custkey").cast("string")).alias("id"),
        F.lit("user").alias("type"),
    ), {"ignoreNullFields": "false"})
    chunks = customer.groupBy(F.floor(F.col("c_custkey") / (5 * CHUNK)).alias("chunk"))
    listed = chunks.agg(F.array_join(F.collect_list(doc), ",").alias("list"))
    folder = new_folder(spark, "owners")
    array = F.concat(F.lit("["), "list", F.lit("]")).alias("value")
    listed.select("chunk", array).write.partitionBy("chunk").text(folder)
    return read_documents(spark, f"{folder}/chunk=*", OWNER, "any")


CATEGORIES_SQL = """
    select 'part ' || p_partkey as category, 0 as pos, 'p' || p_partkey as id, p_name as name,
           p_size::bigint as popularity
    from part
    union all
    select 'part ' || p_partkey, 1, 'q' || p_partkey, p_brand, null::bigint from part
"""


@query(CATEGORIES_SQL)
def scan_category_map_indented(spark, sf_dir):
    """Files indented by two spaces, cut between their categories while reading."""
    first = F.to_json(F.struct(
        F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_size").cast("long").alias("popularity"),
    ))
    second = F.to_json(F.struct(F.concat(F.lit("q"), "p_partkey").alias("id"), F.col("p_brand").alias("name")))
    key = F.to_json(F.array(F.concat(F.lit("part "), "p_partkey")))
    key = F.substring(key, F.lit(2), F.length(key) - 2)
    entry = F.concat(F.lit("  "), key, F.lit(": [\n    "), first, F.lit(",\n    "), second, F.lit("\n  ]"))
    chunks = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / CHUNK).alias("chunk"))
    text = F.concat(F.lit("{\n"), F.array_join(F.collect_list(entry), ",\n"), F.lit("\n}"))
    folder = new_folder(spark, "categories")
    chunks.agg(text.alias("value")).write.partitionBy("chunk").text(folder)
    flat = bronze.flatten_categories(read_category_map(spark, f"{folder}/chunk=*", "indented"))
    return flat.select("category", "pos", "id", "name", "popularity")


@query("""
    select 'tracks' as dataset, count(*) as rows, null::varchar as problem from lineitem
    union all select 'albums', null, 'albums lacks the columns rank, release_year'
""")
def required_columns(spark, sf_dir):
    """A table with the columns it must have, and one without two of them."""
    needed = {"tracks": (tracks, ["id", "album", "duration_ms"]), "albums": (albums, ["id", "rank", "release_year"])}
    found = []
    for name, (docs, columns) in needed.items():
        df = docs(spark, sf_dir)
        try:
            require_columns(df, columns, name)
        except ValueError as error:
            found.append(spark.createDataFrame([(name, None, str(error))], "dataset string, rows long, problem string"))
        else:
            counted = df.agg(F.count(F.lit(1)).alias("rows"))
            found.append(counted.select(F.lit(name).alias("dataset"), "rows", F.lit(None).cast("string").alias("problem")))
    return functools.reduce(DataFrame.unionByName, found)


@query("""
    select 'part ' || p_partkey as category, 0 as pos, 'p' || p_partkey as id, p_name as name,
           p_size::bigint as popularity
    from part
    union all
    select 'part ' || p_partkey, 1, 'q' || p_partkey, p_brand, null::bigint from part
""")
def scan_category_map(spark, sf_dir):
    """Files with one JSON object of category to artists each."""
    first = F.struct(
        F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_size").cast("long").alias("popularity"),
    )
    second = F.struct(
        F.concat(F.lit("q"), "p_partkey").alias("id"), F.col("p_brand").alias("name"),
        F.lit(None).cast("long").alias("popularity"),
    )
    entry = F.struct(F.concat(F.lit("part "), "p_partkey").alias("key"), F.array(first, second).alias("value"))
    chunks = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / CHUNK).alias("chunk"))
    objects = chunks.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    folder = new_folder(spark, "categories")
    objects.write.partitionBy("chunk").text(folder)
    flat = bronze.flatten_categories(read_category_map(spark, f"{folder}/chunk=*", "whole"))
    return flat.select("category", "pos", "id", "name", "popularity")


def dated_albums(spark, sf_dir):
    """Albums with the first day of their order's year as ingest date."""
    orders = table(spark, sf_dir, "orders")
    day = F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 4), F.lit("-01-01"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("album "), "o_orderkey").alias("name"),
        (F.col("o_orderkey") % 20).alias("total_tracks"),
        day.alias("ingest_date"),
    )


DATED_ALBUMS = """
    select o_orderkey::varchar as id, 'album ' || o_orderkey as name, o_orderkey % 20 as total_tracks,
           date_trunc('year', o_orderdate)::date as ingest_date
    from orders
"""


@query(f"select id, name, total_tracks from ({DATED_ALBUMS}) where ingest_date = '1998-01-01'")
def scan_ingest_date(spark, sf_dir):
    root = new_folder(spark, "bronze")
    dated_albums(spark, sf_dir).write.partitionBy("ingest_date").json(f"{root}/albums")
    docs = read_domain(spark, root, "albums", "1998-01-01", ALBUM)
    return docs.select("id", "name", "total_tracks")


@query(f"select * from ({DATED_ALBUMS}) where ingest_date = '1998-01-01'")
def scan_parquet_partition(spark, sf_dir):
    root = new_folder(spark, "silver")
    dated_albums(spark, sf_dir).write.partitionBy("ingest_date").parquet(f"{root}/albums")
    return read_date(spark, f"{root}/albums", "1998-01-01")


@query(f"""
    select id, name, total_tracks, ingest_date from ({DATED_ALBUMS}) where ingest_date <> '1998-01-01'
    union all
    select id, name, total_tracks + 100, ingest_date from ({DATED_ALBUMS}) where ingest_date = '1998-01-01'
""")
def overwrite_ingest_date(spark, sf_dir):
    """All dates are written, then one of them is replaced."""
    path = f"{new_folder(spark, 'silver')}/albums"
    rows = dated_albums(spark, sf_dir)
    rows.write.partitionBy("ingest_date").parquet(path)
    again = rows.where("ingest_date = '1998-01-01'").withColumn("total_tracks", F.col("total_tracks") + 100)
    replace_date(again.drop("ingest_date"), path, "1998-01-01")
    return spark.read.parquet(path)


@query(f"""
    select album_id, album_name, popularity, release_date, total_tracks, artist_id,
           year(release_date)::int as release_year
    from (select id as album_id, name as album_name, popularity, release_day as release_date,
                 total_tracks, unnest(artist_list) as artist_id
          from ({ALBUMS_SQL}))
    where album_id is not null and artist_id is not null
""")
def partition_roundtrip(spark, sf_dir):
    path = new_folder(spark, "album_artists")
    overwrite_by_year(bridge_album_artists(spark, sf_dir), path)
    return spark.read.parquet(path)


# The landed datasets are compared column by column, as text.
LANDED = {
    "tracks": (SILVER_TRACKS, "id name album_id artist_ids disc_number track_number duration_ms explicit popularity release_date is_local type"),
    "albums": (SILVER_ALBUMS, "album_id name album_type total_tracks release_date type artist_ids genres label popularity copyright_text_C copyright_text_P"),
    "artists": (SILVER_ARTISTS, "artist_id name genres followers_total popularity type"),
    "owners": (f"select id as owner_id, display_name, type from ({OWNERS_SQL})", "owner_id display_name type"),
    "playlists": (
        f"select id as playlist_id, * exclude (id) from ({PLAYLISTS_SQL})",
        "playlist_id name description collaborative public followers_total owner_id owner_display_name owner_type primary_color snapshot_id type",
    ),
}
MANIFESTS = ("tracks", "albums", "playlists")


def landed_sql():
    parts = []
    for name, (sql, columns) in LANDED.items():
        line = " || '|' || ".join(f"coalesce({c}::varchar, '-')" for c in columns.split())
        parts.append(f"select '{name}' as dataset, {line} as line from ({sql})")
    parts += [
        f"select '{name}_manifest', '{{\"total_{name}\":' || count(*) || '}}' from ({LANDED[name][0]})"
        for name in MANIFESTS
    ]
    return " union all ".join(parts)


def written_crawl(spark, sf_dir):
    source = new_folder(spark, "crawl")
    for name, docs in {
        "tracks": tracks(spark, sf_dir),
        "albums": albums(spark, sf_dir),
        "artists": artists(spark, sf_dir),
        "owners": owners(spark, sf_dir),
        "playlists": playlists(spark, sf_dir).drop("ord"),
    }.items():
        write_documents(docs, f"{source}/{name}.json", **PACKED)
        if name in MANIFESTS:
            manifest = docs.agg(F.count(F.lit(1)).alias(f"total_{name}"))
            write_documents(manifest, f"{source}/{name}_processing_metadata.json")
    return source


@query(landed_sql())
def land_bronze(spark, sf_dir):
    """A crawl output is gated and landed; all eight datasets are read back."""
    target, day = new_folder(spark, "bronze"), "2024-01-31"
    bronze.land(spark, written_crawl(spark, sf_dir), target, day, layout="lines")
    found = []
    for name, (_, columns) in LANDED.items():
        rows = silver.FLAT_TABLES[name](read_domain(spark, target, name, day, DOCUMENTS[name]))
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns.split()]
        found.append(rows.select(F.lit(name).alias("dataset"), F.concat_ws("|", *texts).alias("line")))
    for name in MANIFESTS:
        lines = spark.read.text(f"{target}/{name}_manifest/ingest_date={day}")
        found.append(lines.select(F.lit(f"{name}_manifest").alias("dataset"), F.col("value").alias("line")))
    return functools.reduce(DataFrame.unionByName, found)


@query("""
    select 'tracks' as dataset, (select count(*) from lineitem where l_linenumber <> 3) as rows,
           (select count(*) from lineitem where l_linenumber = 3) as damaged
    union all select 'albums', count(*), 0 from orders
    union all select 'artists', count(*), 0 from supplier
    union all select 'owners', count(*), 0 from customer
    union all select 'playlists', count(*), 0 from orders
""")
def silver_damaged_rows(spark, sf_dir):
    """Every third line of an order is cut short; the layer counts and refuses."""
    target, day = new_folder(spark, "bronze"), "2024-01-31"
    bronze.land(spark, written_crawl(spark, sf_dir), target, day, layout="lines")
    docs = tracks(spark, sf_dir)
    text = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    cut = F.when(F.col("track_number") == 3, F.left(text, F.length(text) - 5)).otherwise(text)
    replace_date(docs.select(cut.alias("value")), f"{target}/tracks", day, format="text", options=PACKED)
    try:
        results = build_silver(spark, target, new_folder(spark, "silver"), day)
    except LayerFailed as failed:
        results = failed.results
    rows = [(r.dataset, r.rows, r.damaged) for r in results]
    return spark.createDataFrame(rows, "dataset string, rows long, damaged long")


def damaged_bronze(spark, sf_dir, day):
    """Landed tracks of which some are cut short; no other domain was landed."""
    target = new_folder(spark, "bronze")
    docs = tracks(spark, sf_dir)
    text = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    cut = F.when(F.col("track_number") % 5 == 3, F.left(text, F.length(text) - 5)).otherwise(text)
    replace_date(docs.select(cut.alias("value")), f"{target}/tracks", day, format="text", options=PACKED)
    return target


@query(SILVER_TRACKS)
def silver_refused_keeps_old(spark, sf_dir):
    """A date that was built stays as it was when a later run over damaged documents is refused."""
    day, target = "2024-02-01", new_folder(spark, "silver")
    replace_date(silver_tracks(spark, sf_dir), f"{target}/tracks", day)
    try:
        build_silver(spark, damaged_bronze(spark, sf_dir, day), target, day)
    except LayerFailed as failed:
        refused = [r.dataset for r in failed.results if r.damaged]
        return read_date(spark, f"{target}/tracks", day).drop("ingest_date").where(F.lit(refused == ["tracks"]))
    raise AssertionError("damaged documents were not refused")


@query("""
    with damaged as (select count(*) as rows from lineitem where l_linenumber % 5 = 3),
    tracks as (select count(*) as rows from lineitem),
    runs(layer, dataset, columns, refused) as (
      values ('silver', 'tracks', 13, false), ('links', 'track_artists', null, true))
    select layer, dataset, tracks.rows as rows_in, damaged.rows as damaged, columns, refused
    from runs, tracks, damaged
""")
def run_metrics(spark, sf_dir):
    """What two runs over damaged documents recorded, one tolerant and one not."""
    day, metrics, target = "2024-02-01", new_folder(spark, "metrics"), new_folder(spark, "layers")
    source = damaged_bronze(spark, sf_dir, day)
    for build, tolerance in ((build_silver, 10**12), (build_links, 0)):
        try:
            build(spark, source, f"{target}/{build.__name__}", day, tolerance=tolerance, metrics=metrics)
        except LayerFailed:
            pass  # the other domains were not landed for this day
    recorded = spark.read.schema(METRICS).parquet(metrics)
    return recorded.where(F.col("dataset").isin("tracks", "track_artists")).select(
        "layer", "dataset", "rows_in", "damaged", "columns", F.col("error").isNotNull().alias("refused")
    )


@query("""
    select 'tracks' as dataset, count(*) as rows, false as failed from lineitem
    union all select 'albums', count(*), false from orders
    union all select 'artists', null, true
    union all select 'owners', count(*), false from customer
    union all select 'playlists', count(*), false from orders
""")
def layer_results(spark, sf_dir):
    """A missing domain fails the layer, after all others were built."""
    target, day = new_folder(spark, "bronze"), "2024-01-31"
    for name, docs in {"tracks": tracks, "albums": albums, "owners": owners, "playlists": playlists}.items():
        rows = docs(spark, sf_dir)
        write_documents(rows.drop("ord"), f"{target}/{name}/ingest_date={day}", **PACKED)
    try:
        results = build_silver(spark, target, new_folder(spark, "silver"), day)
    except LayerFailed as failed:
        results = failed.results
    rows = [(r.dataset, r.rows, r.error is not None) for r in results]
    return spark.createDataFrame(rows, "dataset string, rows long, failed boolean")


@query(SILVER_TRACKS)
def overwrite_table(spark, sf_dir):
    path = new_folder(spark, "tracks")
    overwrite(silver_tracks(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(f"""
    select * replace (case coalesce(track_number, 0) % 4 when 0 then 'say "hi", ok' when 1 then '  padded  '
                           when 2 then 'a\\b, c' else '' end as name)
    from ({SILVER_TRACKS})
""")
def export_csv_tracks(spark, sf_dir):
    """All columns, with quotes, commas, blanks at the ends, nulls and empty texts."""
    number = F.coalesce("track_number", F.lit(0)) % 4
    odd = F.when(number == 0, 'say "hi", ok').when(number == 1, "  padded  ")
    rows = silver_tracks(spark, sf_dir).withColumn("name", odd.when(number == 2, "a\\b, c").otherwise(""))
    folder = new_folder(spark, "csv")
    export_csv(rows, folder)
    return spark.read.schema(rows.schema).options(**CSV, nullValue="\0").csv(folder)


def exported(spark, sf_dir, table_name, rows):
    source, target = new_folder(spark, "gold"), new_folder(spark, "export")
    replace_date(rows, f"{source}/{table_name}", "2024-01-31")
    export_tables(spark, source, target, [table_name])
    return spark.read.parquet(f"{target}/{table_name}")


@query(f"select *, date '2024-01-31' as ingest_date from ({GOLD_ALBUMS})")
def export_gold(spark, sf_dir):
    return exported(spark, sf_dir, "albums_stats", gold_albums_stats(spark, sf_dir))


@query(f"select *, date '2024-01-31' as ingest_date from ({GOLD_ARTISTS})")
def export_gold_artists(spark, sf_dir):
    return exported(spark, sf_dir, "artists_stats", gold_artists_stats(spark, sf_dir))


@query(SILVER_TRACKS)
def write_json_documents(spark, sf_dir):
    folder = new_folder(spark, "tracks-json")
    write_documents(tracks(spark, sf_dir), folder)
    return silver.tracks(read_stored(spark, folder, TRACK))


@query(OWNERS_SQL)
def read_stored_json(spark, sf_dir):
    folder = new_folder(spark, "owners-json")
    write_documents(owners(spark, sf_dir), folder)
    return read_stored(spark, folder, OWNER)


# --- streams


def message_stream(spark, sf_dir):
    """The events file as a stream of messages."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return encode(event_messages(stream))


@query(f"select * from ({EVENTS_SQL}) where id is not null and id <> ''")
def stream_land_events(spark, sf_dir):
    root = new_folder(spark, "events")
    event_stream.land(message_stream(spark, sf_dir), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(event_stream.EVENT).parquet(f"{root}/table")


# Some events have a time that cannot be read.
BAD_TIME = "popularity % 7 = 3"
BAD_EVENTS_SQL = f"select * replace (case when {BAD_TIME} then 'not a time' else timestamp end as timestamp) from ({EVENTS_SQL})"
#: Ranges of time that events are sent in, one after the other, and rows of a file.
STREAM_PARTS = 6
FILE_ROWS = 100_000


def sent_events(spark, sf_dir, stamp=None, late=None):
    """A stream of files in the order of their times, the files of one range for each trigger.

    Every event is sent one to three times.  ``stamp`` is what stands as its time, by default
    some that cannot be read.  Events without a time come first, ``late`` ones last of all.
    """
    folder = new_folder(spark, "sent")
    flat = event_messages(table(spark, sf_dir, "events")).withColumn("day", F.col("timestamp").cast("timestamp").cast("double"))
    cuts = flat.approxQuantile("day", [i / STREAM_PARTS for i in range(1, STREAM_PARTS)], 0.01)
    part = F.lit(0)
    for i, cut in enumerate(cuts, 1):
        part = F.when(F.col("day") >= cut, i).otherwise(part)
    if late is not None:
        part = F.when(late, STREAM_PARTS).otherwise(part)
    if stamp is None:
        stamp = F.when(F.expr(BAD_TIME), "not a time").otherwise(F.col("timestamp"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("popularity") % 3, F.lit(0))))
    sent = flat.withColumn("_part", part).withColumn("_copy", copies).withColumn("timestamp", stamp)
    files = max(1, -(-flat.count() // (STREAM_PARTS * FILE_ROWS)))
    # The events are made and dealt to ranges in one pass; a range is sent from what is written.
    sent, staged = sent.drop("_copy", "day"), new_folder(spark, "ranges")
    sent.write.partitionBy("_part").parquet(staged)
    dealt = spark.read.schema(sent.schema).parquet(staged)
    for i in range(STREAM_PARTS + (late is not None)):
        rows = encode(dealt.where(F.col("_part") == i).drop("_part"))
        rows.repartition(files).write.mode("append").text(folder)
    discard(spark, staged)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", files).text(folder)
    return event_stream.decode(event_stream.with_arrival(stream), keep=[event_stream.ARRIVAL])


@query(f"select * from ({EVENTS_SQL}) where id is not null and id <> '' and not {BAD_TIME}")
def stream_dedup_events(spark, sf_dir):
    """No event with a readable time is lost, though others have none."""
    root = new_folder(spark, "events")
    kept = event_stream.deduplicate(sent_events(spark, sf_dir), delay="1 day")
    event_stream.append_to(kept, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(event_stream.EVENT).parquet(f"{root}/table")


@query(f"select * from ({BAD_EVENTS_SQL}) where id is not null and id <> '' and {BAD_TIME}")
def stream_untimed_events(spark, sf_dir):
    """The events that were set aside, deduplicated in batch."""
    root = new_folder(spark, "events")
    aside = event_stream.untimed(sent_events(spark, sf_dir))
    event_stream.append_to(aside, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    landed = spark.read.schema(event_stream.EVENT).parquet(f"{root}/table")
    return keep_first(landed, ["id", "timestamp"], ["name"])


# Times that are missing, cannot be read, or lie far ahead.
ODD_TIME = "popularity % 7 in (1, 3, 5)"
ODD_STAMP = """
    case popularity % 7 when 1 then null when 3 then 'not a time' when 5 then '2999-01-01T00:00:00.000000'
    else timestamp end
"""
SENT = "id is not null and id <> ''"


@query(f"select * from ({EVENTS_SQL}) where {SENT} and not {ODD_TIME}")
def stream_odd_times(spark, sf_dir):
    """No event with a good time is lost, though others claim to be from another millennium."""
    root = new_folder(spark, "events")
    kept = event_stream.deduplicate(sent_events(spark, sf_dir, F.expr(ODD_STAMP)), delay="1 day")
    event_stream.follow(event_stream.append_to(kept, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.schema(event_stream.EVENT).parquet(f"{root}/table")


@query(f"""
    select * replace ({ODD_STAMP} as timestamp), case popularity % 7 when 5 then 'ahead' else 'unreadable' end as reason
    from ({EVENTS_SQL}) where {SENT} and {ODD_TIME}
""")
def stream_set_aside_events(spark, sf_dir):
    """The events whose time is not believed, with the reason, deduplicated in batch."""
    root = new_folder(spark, "events")
    aside = event_stream.set_aside(sent_events(spark, sf_dir, F.expr(ODD_STAMP)))
    event_stream.append_to(aside, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    landed = spark.read.schema(f"{event_stream.EVENT}, reason string").parquet(f"{root}/table")
    return event_stream.rebuild(landed)


LATE = "popularity % 5 = 2"


@query(f"select * from ({EVENTS_SQL}) where {SENT}")
def stream_late_rebuild(spark, sf_dir):
    """Events that come after all others are dropped by the stream and found again in what was landed."""
    root = new_folder(spark, "events")
    sent = sent_events(spark, sf_dir, F.col("timestamp"), late=F.expr(LATE))
    landing = event_stream.append_to(sent.drop(event_stream.ARRIVAL), f"{root}/bronze", f"{root}/landed")
    kept = event_stream.deduplicate(sent, delay="1 day")
    dropped = event_stream.follow(event_stream.append_to(kept, f"{root}/silver", f"{root}/checkpoint"))
    landing.awaitTermination()
    silver_events = spark.read.schema(event_stream.EVENT).parquet(f"{root}/silver")
    landed = spark.read.schema(event_stream.EVENT).parquet(f"{root}/bronze")
    lost = event_stream.lost_events(landed, silver_events)
    if not sum(dropped.values()):
        raise AssertionError("nothing came late")
    return silver_events.unionByName(lost)


@query(f"select * from ({EVENTS_SQL}) where {SENT}")
def rebuild_events(spark, sf_dir):
    """Silver events worked out anew from all that was landed, copies included."""
    root = new_folder(spark, "events")
    landed = sent_events(spark, sf_dir, F.col("timestamp")).drop(event_stream.ARRIVAL)
    event_stream.append_to(landed, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    overwrite(event_stream.rebuild(spark.read.schema(event_stream.EVENT).parquet(f"{root}/bronze")), f"{root}/silver")
    return spark.read.schema(event_stream.EVENT).parquet(f"{root}/silver")


@query(f"select count(*) as messages from ({EVENTS_SQL}) where id is null or id = ''")
def stream_rejected_events(spark, sf_dir):
    root = new_folder(spark, "events")
    refused = event_stream.rejected(message_stream(spark, sf_dir))
    event_stream.append_to(refused, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("value string").parquet(f"{root}/table").agg(F.count(F.lit(1)).alias("messages"))


@query(f"select distinct artist, popularity from ({EVENTS_SQL}) where id is not null and id <> ''")
def stream_dedup_keys(spark, sf_dir):
    root = new_folder(spark, "events")
    sent = event_stream.decode(message_stream(spark, sf_dir))
    kept = event_stream.deduplicate(sent, delay="40 days", keys=["artist", "popularity"])
    event_stream.append_to(kept, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/table").select("artist", "popularity")
