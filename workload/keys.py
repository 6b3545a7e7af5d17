"""Deduplication, key sets, incremental loads, ranking and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from discolake.operators import dedup, quality, ranking
from discolake.operators.joins import excluding, matching
from discolake.plans import bronze, increment
from discolake.plans.silver import track_artists
from discolake.schemas import KEYS, TRACK
from discolake.session import new_folder
from discolake.sinks.buckets import Bucketed
from discolake.sinks.exports import write_documents
from discolake.sinks.staging import PACKED
from discolake.sources.documents import read_stored
from discolake.sources.manifests import explode_keys, read_keys, read_manifest_keys
from workload.inputs import PLAYLISTS_SQL, TRACKS_SQL, table
from workload.registry import query
from workload.tables import albums, artists, owners, playlists, tracks

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


@query(f"""
    select {LINE_ORDER_SQL} from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) = 1
""")
def dedup_keep_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(LINE_ORDER)
    return dedup.keep_first(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER[2:])


@query(f"""
    select owner_display_name as display_name, owner_id as id, owner_type as type
    from ({PLAYLISTS_SQL}) where owner_id is not null and owner_id <> ''
    qualify row_number() over (partition by owner_id order by ord) = 1
""")
def owners_from_playlists(spark, sf_dir):
    return bronze.owners_from_playlists(playlists(spark, sf_dir), ["ord"])


@query("""
    select count(*) as total_rows, count(distinct nullif(text, '')) as unique_keys,
           count(*) - count(distinct nullif(text, '')) as removed_rows
    from documents
""")
def dedup_report(spark, sf_dir):
    """Whole texts are compared by digest, so that texts are not shuffled."""
    text = F.col("text")
    return quality.dedup_report(table(spark, sf_dir, "documents"), F.when(text != "", F.sha2(text, 256)))


@query("""
    select distinct id from (
        select unnest([o_custkey::varchar, 'x' || (o_orderkey % 50), null]) as id from orders)
    where id is not null
""")
def manifest_keys(spark, sf_dir):
    listed = F.array(
        F.col("o_custkey").cast("string"),
        F.concat(F.lit("x"), F.col("o_orderkey") % 50),
        F.lit(None).cast("string"),
    )
    manifests = table(spark, sf_dir, "orders").select(listed.alias("processed_artists"))
    return explode_keys(manifests, "processed_artists")


def processed_customers(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")


@query("""
    select c_custkey, c_name, c_mktsegment from customer
    where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')
""")
def semi_processed(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    keys = processed_customers(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    return matching(parents, keys, "c_custkey")


@query("""
    select l_orderkey, l_linenumber, l_partkey from lineitem
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')
""")
def anti_unprocessed(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keys = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return excluding(rows, keys.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


def order_tracks(spark, sf_dir, status):
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
    return lines.select(F.concat(F.lit("t"), "l_orderkey").alias("id"), *LINE_ORDER)


@query(f"""
    with stored as (
        select 't' || l_orderkey as id, {LINE_ORDER_SQL} from lineitem where l_linestatus = 'F'),
    fresh as (
        select 't' || l_orderkey as id, {LINE_ORDER_SQL} from lineitem where l_linestatus = 'O'
        qualify row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) = 1)
    select * from stored
    union all
    select * from fresh where id not in (select id from stored)
""")
def append_new_only(spark, sf_dir):
    """The first open line of each order that has no finished one."""
    stored = order_tracks(spark, sf_dir, "F")
    return dedup.append_new(stored, order_tracks(spark, sf_dir, "O"), "id", LINE_ORDER)


@query("""
    select o_orderkey, o_custkey, null::varchar as o_orderpriority from orders where o_orderstatus = 'F'
    union all
    select o_orderkey, o_custkey, o_orderpriority from orders where o_orderstatus <> 'F'
""")
def union_pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    rest = orders.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderpriority", "o_orderkey")
    done = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return dedup.union_pages(rest, done)


# --- incremental load: orders are the parents, line items offer the children

CHILD_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
CHILD_ORDER_SQL = ", ".join(CHILD_ORDER)


def load_inputs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    order_id = F.col("o_orderkey").cast("string")
    outcome = F.when(F.col("o_orderpriority") == "1-URGENT", "rate_limited").when(
        F.col("o_orderpriority") == "5-LOW", "failed"
    )
    parents = orders.select(
        order_id.alias("id"), F.col("o_orderkey").alias("ord"), outcome.alias("outcome"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("release_date"),
    )
    status = F.when(F.col("o_custkey") % 4 == 0, "retry").otherwise("done")
    keys = orders.where("o_orderstatus = 'F'").select(order_id.alias("id"), status.alias("status"))
    item = F.struct(
        F.when(F.col("l_suppkey") % 11 != 3, F.concat(F.lit("p"), "l_partkey")).alias("id"),
        F.concat(F.lit("track "), "l_partkey").alias("name"),
    )
    candidates = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("parent_id"),
        F.when(F.col("l_suppkey") % 13 != 3, item).alias("item"),
        *CHILD_ORDER,
    )
    stored = table(spark, sf_dir, "part").where("p_size <= 10")
    stored = stored.select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("name"))
    return parents, candidates, stored, keys


CHILD = "id string, name string, parent_id string, release_date string"


def committed(spark, sf_dir, per_parent=3):
    """Folders of children and keys after a run, and the key rows of the run."""
    parents, candidates, stored, keys = load_inputs(spark, sf_dir)
    children, key_table = new_folder(spark, "children"), new_folder(spark, "keys")
    stored.write.parquet(children)
    keys.write.parquet(key_table)
    run = increment.load(
        parents, candidates, read_stored(spark, children, CHILD, "parquet"), read_keys(spark, key_table),
        parent_order=["ord"], child_order=CHILD_ORDER, per_parent=per_parent, inherited=["release_date"],
    )
    return children, run, increment.commit(run, children, key_table)


def load_sql(per_parent=None):
    limit = "" if per_parent is None else (
        f"qualify row_number() over (partition by l_orderkey order by {CHILD_ORDER_SQL}) <= {per_parent}"
    )
    return f"""
    with todo as (
        select * from orders where not (o_orderstatus = 'F' and o_custkey % 4 <> 0)),
    listed as (select * from lineitem {limit}),
    stored as (select 'p' || p_partkey as id, p_name as name from part where p_size <= 10),
    fresh as (
        select 'p' || l_partkey as id, 'track ' || l_partkey as name, l_orderkey::varchar as parent_id,
               strftime(o_orderdate, '%Y-%m-%d') as release_date
        from listed join todo on o_orderkey = l_orderkey
        where l_suppkey % 13 <> 3 and l_suppkey % 11 <> 3
        qualify row_number() over (partition by l_partkey order by o_orderkey, {CHILD_ORDER_SQL}) = 1),
    outcomes as (
        select o_orderkey::varchar as id,
               case when o_orderpriority = '1-URGENT' then 'retry'
                    when o_orderpriority = '5-LOW' then 'failed'
                    when count(l_orderkey) = 0 then 'empty' else 'done' end as status,
               count(l_orderkey) as children
        from todo left join listed on l_orderkey = o_orderkey
        group by o_orderkey, o_orderpriority),
    after_run as (
        select id, name, null::varchar as parent_id, null::varchar as release_date from stored
        union all
        select id, name, parent_id, release_date from fresh where id not in (select id from stored))
    """


@query(f"{load_sql(3)} select * from after_run")
def incremental_load(spark, sf_dir):
    """The stored children after the run, at most three of each parent."""
    return read_stored(spark, committed(spark, sf_dir)[0], CHILD, "parquet")


@query(f"{load_sql()} select * from after_run")
def incremental_load_all(spark, sf_dir):
    """The stored children after a run that takes all children."""
    return read_stored(spark, committed(spark, sf_dir, None)[0], CHILD, "parquet")


@query(f"{load_sql(3)} select * from outcomes")
def key_status(spark, sf_dir):
    return committed(spark, sf_dir)[1].outcomes


@query(f"""
    {load_sql(3)}
    select (select count(distinct id) from after_run) as total_children,
           (select count(*) from outcomes where status <> 'retry') as total_processed,
           (select count(*) from orders) - (select count(*) from todo) as total_skipped,
           '2024-01-31 00:00:00' as last_update, 'completed' as status
""")
def run_manifest(spark, sf_dir):
    """Counted from the tables that the run wrote."""
    children, _, outcomes = committed(spark, sf_dir)
    parents = load_inputs(spark, sf_dir)[0]
    stored = read_stored(spark, children, CHILD, "parquet")
    return increment.run_manifest(parents, outcomes, stored, F.lit("2024-01-31 00:00:00"))


@query("""
    select c_custkey::varchar as id from customer where c_custkey % 3 <> 0
""")
def scan_manifest_keys(spark, sf_dir):
    """Manifest files indented by two spaces, of at most 2,000 keys each."""
    listed = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0")
    entry = F.concat(F.lit('    "'), "c_custkey", F.lit('"'))
    files = listed.groupBy(F.floor(F.col("c_custkey") / 3000).alias("chunk")).agg(
        F.array_join(F.collect_list(entry), ",\n").alias("keys")
    )
    text = F.concat(F.lit('{\n  "processed_artists": [\n'), "keys", F.lit('\n  ],\n  "total_albums": 5\n}'))
    folder = new_folder(spark, "manifests")
    files.select("chunk", text.alias("value")).write.partitionBy("chunk").text(folder)
    return read_manifest_keys(spark, f"{folder}/chunk=*", "processed_artists")


# --- ranking and sampling


@query("""
    select conv_id, turn, role, text from conversations
    qualify row_number() over (partition by conv_id order by turn, role, text) <= 3
""")
def first_n_per_parent(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return ranking.first_n_per_parent(turns, "conv_id", ["turn", "role", "text"], 3)


@query(f"""
    select l_suppkey, {", ".join(c for c in LINE_ORDER if c != "l_suppkey")} from lineitem
    qualify row_number() over (partition by l_suppkey order by {LINE_ORDER_SQL}) <= 10
""")
def first_tracks_per_artist(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(LINE_ORDER)
    return ranking.first_n_per_parent(lines, "l_suppkey", LINE_ORDER, 10)


@query("""
    select o_orderkey, o_orderpriority, least(o_orderkey, 50) as polled
    from orders order by o_orderdate, o_orderkey limit 50
""")
def first_n(spark, sf_dir):
    """The first 50 orders; ``polled`` shows the size rule on each key."""
    first = ranking.first_n(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 50)
    return first.select("o_orderkey", "o_orderpriority", ranking.poll_size("o_orderkey", 50).alias("polled"))


@query("""
    select c_custkey, c_name from customer
    order by md5(c_custkey::varchar || ':42'), c_custkey limit 500
""")
def seeded_sample(spark, sf_dir):
    return ranking.seeded_sample(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 500)


@query("""
    select event_id, event_type from events
    qualify row_number() over (order by md5(event_id::varchar || ':42'), event_id) <= (select count(*) // 10 from events)
""")
def seeded_sample_tenth(spark, sf_dir):
    """A tenth of all events, picked without putting them in order."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ranking.seeded_sample(events, "event_id", events.count() // 10, few=0)


@query(f"""
    select {LINE_ORDER_SQL} from lineitem
    qualify row_number() over (order by l_shipdate desc, {LINE_ORDER_SQL}) <= (select count(*) // 3 from lineitem)
""")
def first_many_lines(spark, sf_dir):
    """The last third of all lines by date, from whole ranges and one that is cut."""
    lines = table(spark, sf_dir, "lineitem").select(LINE_ORDER)
    return ranking.first_many(lines, [F.desc("l_shipdate"), *LINE_ORDER], lines.count() // 3)


@query(f"{load_sql()} select * from after_run")
def incremental_load_bucketed(spark, sf_dir):
    """The stored children after a run over bucketed tables."""
    parents, candidates, stored, keys = load_inputs(spark, sf_dir)
    children = Bucketed(new_folder(spark, "children"), CHILD, "id", 16)
    key_table = Bucketed(new_folder(spark, "keys"), KEYS, "id", 16)
    none = F.lit(None).cast("string")
    children.append(stored.withColumns({"parent_id": none, "release_date": none}))
    key_table.append(keys)
    run = increment.load(
        parents, candidates, children.read(spark), key_table.read(spark),
        parent_order=["ord"], child_order=CHILD_ORDER, per_parent=None, inherited=["release_date"],
    )
    increment.commit(run, children, key_table)
    return children.read(spark)


# --- counts


@query("""
    select 'tracks' as dataset, true as present, count(*) as rows, count(*) > 0 as ok from lineitem
    union all select 'albums', true, count(*), count(*) > 0 from orders
    union all select 'artists', true, count(*), count(*) > 0 from supplier
    union all select 'owners', true, count(*), count(*) > 0 from customer
    union all select 'playlists', true, count(*), count(*) > 0 from orders
    union all select 'genres', true, 0, false
    union all select 'albums_manifest', false, 0, false
""")
def completeness_report(spark, sf_dir):
    return quality.completeness(
        spark,
        {
            "tracks": tracks(spark, sf_dir),
            "albums": albums(spark, sf_dir),
            "artists": artists(spark, sf_dir),
            "owners": owners(spark, sf_dir),
            "playlists": playlists(spark, sf_dir),
            "genres": table(spark, sf_dir, "part").where("p_partkey < 0"),
            "albums_manifest": None,
        },
    )


@query(f"""
    select 'track_artists' as step, (select count(*) from ({TRACKS_SQL})) as rows_in,
           (select count(*) from (select id, album_id, unnest(artist_list) as artist_id from ({TRACKS_SQL}))
            where id is not null and album_id is not null and artist_id is not null) as rows_out
""")
def step_metrics(spark, sf_dir):
    """Rows into and out of one step, counted while it runs."""
    docs, rows_in = quality.observed_rows(tracks(spark, sf_dir), "rows_in")
    links, rows_out = quality.observed_rows(track_artists(docs), "rows_out")
    links.write.format("noop").mode("overwrite").save()
    row = ("track_artists", rows_in.get["rows"], rows_out.get["rows"])
    return spark.createDataFrame([row], "step string, rows_in long, rows_out long")


# --- loads with damaged candidates, from files


def track_lines(spark, sf_dir):
    """Line items as candidates of one JSON text each; some are marked to be cut."""
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    line = F.struct(
        F.col("l_orderkey").cast("string").alias("parent_id"),
        F.col("l_linenumber").cast("long").alias("ord"),
        F.struct(line_id.alias("id"), F.concat(F.lit("track "), "l_partkey").alias("name")).alias("item"),
    )
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.to_json(line).alias("value"), (F.col("l_partkey") % 7 == 3).alias("cut"))


def damaged_load(spark, sf_dir):
    """Folders of children, keys and rejects after two runs; in the first some lines are cut."""
    root = new_folder(spark, "damaged")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("release_date"),
    )
    write_documents(orders, f"{root}/parents")
    lines = track_lines(spark, sf_dir)
    cut = F.when(F.col("cut"), F.left("value", F.length("value") - 12)).otherwise(F.col("value"))
    lines.select(cut.alias("value")).write.options(**PACKED).text(f"{root}/first")
    lines.select("value").write.options(**PACKED).text(f"{root}/repaired")
    paths = f"{root}/children", f"{root}/keys"
    increment.run(spark, "tracks", f"{root}/parents", f"{root}/first", *paths, layout="lines", rejects=f"{root}/rejects")
    increment.run(spark, "tracks", f"{root}/parents", f"{root}/repaired", *paths, layout="lines")
    return *paths, f"{root}/rejects"


@query("""
    select distinct l_orderkey || '-' || l_linenumber as id, strftime(o_orderdate, '%Y-%m-%d') as release_date
    from lineitem join orders on o_orderkey = l_orderkey
""")
def load_with_damage(spark, sf_dir):
    """No child is lost whose line was cut in the first run and whole in the second."""
    children = damaged_load(spark, sf_dir)[0]
    return read_stored(spark, children, TRACK, "parquet").select("id", "release_date")


@query("""
    with held as (select l_orderkey as id from lineitem group by 1 having bool_or(l_partkey % 7 = 3))
    select o_orderkey::varchar as id, 'retry' as status from orders where o_orderkey in (select id from held)
    union all
    select o_orderkey::varchar,
           case when o_orderkey in (select l_orderkey from lineitem) then 'done' else 'empty' end
    from orders
""")
def load_with_damage_keys(spark, sf_dir):
    """The parents of cut lines are tried again, and all are settled in the end."""
    return read_keys(spark, damaged_load(spark, sf_dir)[1])


@query("select l_orderkey::varchar as parent_id, count(*) as lines from lineitem where l_partkey % 7 = 3 group by 1")
def load_rejects(spark, sf_dir):
    """The lines that the first run could not read, by the parent they still name."""
    rejects = spark.read.schema(increment.REJECTS).parquet(damaged_load(spark, sf_dir)[2])
    return rejects.groupBy("parent_id").agg(F.count("line").alias("lines"))


@query("select c_custkey::varchar as id from customer")
def scan_all_manifest_keys(spark, sf_dir):
    """Manifest files indented by two spaces that list every customer, some of them twice."""
    listed = table(spark, sf_dir, "customer")
    entry = F.concat(F.lit('    "'), "c_custkey", F.lit('"'))
    copies = F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 5 == 0).cast("int")))
    files = listed.withColumn("copy", copies).groupBy(F.floor(F.col("c_custkey") / 2000).alias("chunk"), "copy").agg(
        F.array_join(F.collect_list(entry), ",\n").alias("keys")
    )
    text = F.concat(F.lit('{\n  "processed_artists": [\n'), "keys", F.lit('\n  ],\n  "status": "completed"\n}'))
    folder = new_folder(spark, "manifests")
    files.select("chunk", "copy", text.alias("value")).write.partitionBy("chunk", "copy").text(folder)
    return read_manifest_keys(spark, f"{folder}/chunk=*/copy=*", "processed_artists")


@query("""
    select (select count(distinct id) from (
              select 'p' || p_partkey as id from part where p_size <= 10
              union all select 'new') t) as total_children,
           100 as total_processed,
           (select count(*) from orders where o_orderstatus = 'F' and o_custkey % 4 <> 0) as total_skipped
""")
def run_manifest_of_a_sample(spark, sf_dir):
    """Parents that a sample passed over are not skipped ones: they are still pending."""
    parents, candidates, stored, keys = load_inputs(spark, sf_dir)
    parents = parents.drop("outcome")
    one = candidates.withColumn("item", F.struct(F.lit("new").alias("id"), F.lit("name").alias("name")))
    children, key_table = new_folder(spark, "children"), new_folder(spark, "keys")
    stored.write.parquet(children)
    keys.write.parquet(key_table)
    run = increment.load(
        parents, one, read_stored(spark, children, CHILD, "parquet"), read_keys(spark, key_table),
        parent_order=["ord"], child_order=CHILD_ORDER, per_parent=3, inherited=["release_date"], sample=100,
    )
    outcomes = increment.commit(run, children, key_table)
    after = read_stored(spark, children, CHILD, "parquet")
    row = increment.run_manifest(parents, outcomes, after, keys=read_keys(spark, key_table))
    return row.select("total_children", "total_processed", "total_skipped")
