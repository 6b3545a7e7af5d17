"""The catalogue's documents, derived row by row from the driver tables.

Each builder has a SQL twin that gives the same rows flat: lists of ids are
lists of strings there, structs are prefixed columns.  Some rows get the
nulls and empty lists that the driver tables lack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_tracks(lineitem: DataFrame) -> DataFrame:
    """Line items as track documents: the order is the album, the supplier
    and, on even lines, the part are the artists."""
    return lineitem.selectExpr(
        "case when l_partkey % 101 = 7 then null"
        " else concat(l_orderkey, '-', l_linenumber) end as id",
        "concat('track ', l_partkey) as name",
        "case when l_partkey % 97 = 5 then null else named_struct('id',"
        " case when l_partkey % 89 = 5 then null else cast(l_orderkey as string) end) end as album",
        "case when l_partkey % 53 = 5 then null"
        " when l_partkey % 59 = 5 then array()"
        " when l_partkey % 61 = 5 then array(named_struct('id', concat('s', l_suppkey)),"
        "   named_struct('id', cast(null as string)))"
        " when l_linenumber % 2 = 0 then array(named_struct('id', concat('s', l_suppkey)),"
        "   named_struct('id', concat('p', l_partkey)))"
        " else array(named_struct('id', concat('s', l_suppkey))) end as artists",
        "cast(1 + l_linenumber % 2 as long) as disc_number",
        "cast(l_linenumber as long) as track_number",
        "case when l_quantity = 13 then null"
        " else cast(round(l_extendedprice * 100) as long) end as duration_ms",
        "l_returnflag = 'R' as explicit",
        "l_linestatus = 'O' as is_local",
        "case when l_quantity = 7 then null else cast(l_quantity as long) end as popularity",
        "substring(cast(l_shipdate as string), 1, 10) as release_date",
        "'track' as type",
    )


TRACKS_SQL = """
    select
        case when l_partkey % 101 = 7 then null
             else l_orderkey || '-' || l_linenumber end as id,
        'track ' || l_partkey as name,
        case when l_partkey % 97 = 5 or l_partkey % 89 = 5 then null
             else l_orderkey::varchar end as album_id,
        case when l_partkey % 53 = 5 then null
             when l_partkey % 59 = 5 then []::varchar[]
             when l_partkey % 61 = 5 then ['s' || l_suppkey, null]
             when l_linenumber % 2 = 0 then ['s' || l_suppkey, 'p' || l_partkey]
             else ['s' || l_suppkey] end as artist_list,
        (1 + l_linenumber % 2)::bigint as disc_number,
        l_linenumber::bigint as track_number,
        case when l_quantity = 13 then null
             else round(l_extendedprice * 100)::bigint end as duration_ms,
        l_returnflag = 'R' as explicit,
        l_linestatus = 'O' as is_local,
        case when l_quantity = 7 then null else l_quantity::bigint end as popularity,
        strftime(l_shipdate, '%Y-%m-%d') as release_date,
        'track' as type
    from lineitem
"""


def order_albums(orders: DataFrame) -> DataFrame:
    """Orders as album documents, with release dates of every precision."""
    day = "cast(o_orderdate as string)"
    return orders.selectExpr(
        "case when o_orderkey % 211 = 5 then null else cast(o_orderkey as string) end as id",
        "concat('album ', o_orderkey) as name",
        "case o_orderstatus when 'F' then 'album' when 'O' then 'single' else 'compilation' end"
        " as album_type",
        "'album' as type",
        "o_orderkey % 20 as total_tracks",
        f"case o_orderkey % 5 when 0 then substring({day}, 1, 4) when 1 then substring({day}, 1, 7)"
        f" when 2 then substring({day}, 1, 10) when 3 then 'N/A' else null end as release_date",
        "case when o_orderkey % 31 = 5 then null when o_orderkey % 37 = 5 then array()"
        " else array(named_struct('id', concat('s', o_custkey % 100)),"
        "   named_struct('id', case when o_orderkey % 3 = 0 then null"
        "     else concat('s', o_orderkey % 100) end)) end as artists",
        "case o_orderkey % 5 when 0 then null"
        " when 1 then array(named_struct('text', concat('p ', o_custkey), 'type', 'P'))"
        " when 2 then array(named_struct('text', concat('c ', o_custkey), 'type', 'C'),"
        "   named_struct('text', concat('p ', o_custkey), 'type', 'P'))"
        " when 3 then array(named_struct('text', cast(null as string), 'type', 'C'),"
        "   named_struct('text', 'late', 'type', 'C'))"
        " else array() end as copyrights",
        "case o_orderkey % 4 when 0 then null when 1 then array()"
        " when 2 then array('pop', lower(o_orderpriority))"
        " else array('rock', cast(null as string)) end as genres",
        "o_orderpriority as label",
        "cast(floor(o_totalprice) as long) % 101 as popularity",
    )


ALBUMS_SQL = """
    select
        case when o_orderkey % 211 = 5 then null else o_orderkey::varchar end as id,
        'album ' || o_orderkey as name,
        case o_orderstatus when 'F' then 'album' when 'O' then 'single'
             else 'compilation' end as album_type,
        'album' as type,
        o_orderkey % 20 as total_tracks,
        case o_orderkey % 5 when 0 then strftime(o_orderdate, '%Y')
             when 1 then strftime(o_orderdate, '%Y-%m')
             when 2 then strftime(o_orderdate, '%Y-%m-%d')
             when 3 then 'N/A' else null end as release_date,
        case o_orderkey % 5 when 0 then date_trunc('year', o_orderdate)::date
             when 1 then date_trunc('month', o_orderdate)::date
             when 2 then o_orderdate::date else null end as release_day,
        case when o_orderkey % 31 = 5 then null
             when o_orderkey % 37 = 5 then []::varchar[]
             else ['s' || (o_custkey % 100),
                   case when o_orderkey % 3 = 0 then null else 's' || (o_orderkey % 100) end]
             end as artist_list,
        case o_orderkey % 5 when 2 then 'c ' || o_custkey else null end as copyright_text_C,
        case when o_orderkey % 5 in (1, 2) then 'p ' || o_custkey else null end as copyright_text_P,
        case o_orderkey % 4 when 0 then null when 1 then ''
             when 2 then 'pop,' || lower(o_orderpriority) else 'rock,None' end as genres,
        o_orderpriority as label,
        floor(o_totalprice)::bigint % 101 as popularity
    from orders
"""


def supplier_artists(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "case when s_suppkey % 41 = 5 then null else concat('s', s_suppkey) end as id",
        "s_name as name",
        "case s_suppkey % 3 when 0 then null when 1 then array()"
        " else array('rock', concat('nation ', s_nationkey)) end as genres",
        "case when s_suppkey % 17 = 5 then null"
        " else named_struct('total', cast(floor(s_acctbal) as long)) end as followers",
        "s_suppkey % 101 as popularity",
        "'artist' as type",
    )


ARTISTS_SQL = """
    select
        case when s_suppkey % 41 = 5 then null else 's' || s_suppkey end as id,
        s_name as name,
        case s_suppkey % 3 when 0 then null when 1 then ''
             else 'rock,nation ' || s_nationkey end as genres,
        case when s_suppkey % 17 = 5 then null
             else floor(s_acctbal)::bigint end as followers_total,
        s_suppkey % 101 as popularity,
        'artist' as type
    from supplier
"""


def order_playlists(orders: DataFrame) -> DataFrame:
    """Orders as playlist documents; the customer is the owner.

    The owner's display name differs between playlists, so that it matters
    which one is kept.
    """
    return orders.selectExpr(
        "case when o_orderkey % 211 = 5 then null else cast(o_orderkey as string) end as id",
        "case when o_orderkey % 19 = 5 then null else concat('playlist ', o_orderkey) end as name",
        "o_orderpriority as description",
        "o_orderstatus = 'P' as collaborative",
        "o_orderstatus = 'O' as public",
        "case when o_orderkey % 7 = 5 then null else named_struct('href', cast(null as string),"
        " 'total', cast(floor(o_totalprice) as long)) end as followers",
        "case when o_orderkey % 11 = 5 then null else named_struct("
        " 'display_name', concat('owner ', o_custkey, ' in ', o_orderkey),"
        " 'id', case when o_orderkey % 13 = 5 then '' when o_orderkey % 23 = 5 then null"
        "   else cast(o_custkey as string) end,"
        " 'type', 'user') end as owner",
        "cast(null as string) as primary_color",
        "concat('snap-', o_orderkey) as snapshot_id",
        "'playlist' as type",
        "o_orderkey as ord",
    )


PLAYLISTS_SQL = """
    select
        case when o_orderkey % 211 = 5 then null else o_orderkey::varchar end as id,
        case when o_orderkey % 19 = 5 then null else 'playlist ' || o_orderkey end as name,
        o_orderpriority as description,
        o_orderstatus = 'P' as collaborative,
        o_orderstatus = 'O' as public,
        case when o_orderkey % 7 = 5 then null
             else floor(o_totalprice)::bigint end as followers_total,
        case when o_orderkey % 11 = 5 or (o_orderkey % 13 <> 5 and o_orderkey % 23 = 5) then null
             when o_orderkey % 13 = 5 then '' else o_custkey::varchar end as owner_id,
        case when o_orderkey % 11 = 5 then null
             else 'owner ' || o_custkey || ' in ' || o_orderkey end as owner_display_name,
        case when o_orderkey % 11 = 5 then null else 'user' end as owner_type,
        null::varchar as primary_color,
        'snap-' || o_orderkey as snapshot_id,
        'playlist' as type,
        o_orderkey as ord
    from orders
"""


def customer_owners(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_name as display_name",
        "case when c_custkey % 29 = 5 then null else cast(c_custkey as string) end as id",
        "'user' as type",
    )


OWNERS_SQL = """
    select c_name as display_name,
           case when c_custkey % 29 = 5 then null else c_custkey::varchar end as id,
           'user' as type
    from customer
"""


def event_messages(events: DataFrame) -> DataFrame:
    """Events as flat track events; some lack an id."""
    return events.selectExpr(
        "case when event_id % 10 = 3 then '' when event_id % 10 = 4 then null"
        " else cast(event_id as string) end as id",
        "event_type as name",
        "concat('user ', user_id) as artist",
        "concat('album ', user_id) as album",
        "substring(cast(ts as string), 1, 10) as release_date",
        "cast(floor(value * 1000) as long) as duration_ms",
        "cast(get_json_object(props, '$.k') as long) as popularity",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") as timestamp",
    )


EVENTS_SQL = """
    select case when event_id % 10 = 3 then '' when event_id % 10 = 4 then null
                else event_id::varchar end as id,
           event_type as name,
           'user ' || user_id as artist,
           'album ' || user_id as album,
           strftime(ts, '%Y-%m-%d') as release_date,
           floor(value * 1000)::bigint as duration_ms,
           json_extract_string(props, '$.k')::bigint as popularity,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp
    from events
"""
