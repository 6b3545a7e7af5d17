"""The physical plans: what is pushed, combined early, pruned and split."""

import contextlib
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from discolake.operators import dedup, filters, joins, ranking
from discolake.plans import gold, increment, silver
from discolake.plans.bronze import artists_from_categories
from discolake.schemas import TRACK
from discolake.sinks.buckets import Bucketed
from discolake.sinks.tables import replace_date
from discolake.sources.documents import read_category_map, read_documents
from discolake.sources.tables import read_date
from workload import QUERIES
from tests.conftest import rows
from workload.inputs import lineitem_tracks

SF = "/root/testdata/sf0.001"


def plan(df, mode=None):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture
def silver_tables(spark, tmp_path):
    tracks = silver.tracks(lineitem_tracks(spark.read.parquet(f"{SF}/lineitem.parquet")))
    tracks.write.parquet(str(tmp_path / "tracks"))
    return spark.read.parquet(str(tmp_path / "tracks"))


def test_gold_groups_read_few_columns_and_combine_before_the_shuffle(silver_tables):
    albums = plan(gold.album_groups(silver_tables))
    assert "ReadSchema: struct<id:string,album_id:string,duration_ms:bigint,popularity:bigint>" in albums
    assert "IsNotNull(album_id)" in albums
    assert albums.index("HashAggregate") < albums.index("Exchange") < albums.rindex("partial_count")
    assert albums.count("Exchange") == 1
    artists = plan(gold.artist_groups(silver_tables))
    assert "ReadSchema: struct<id:string,artist_ids:string,popularity:bigint>" in artists
    assert artists.count("Exchange") == 1 and "partial_count" in artists


def test_key_filters_reach_the_scan(silver_tables):
    text = plan(filters.drop_missing(silver_tables, ["id", "album_id"]))
    assert "PushedFilters: [IsNotNull(id), IsNotNull(album_id)]" in text


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_documents_are_parsed_once(spark, write_json, layout):
    path = write_json("tracks.json", [{"id": "t", "album": {"id": "a"}, "artists": [{"id": "x"}]}])
    text = plan(silver.track_artists(read_documents(spark, path, TRACK, layout)))
    assert text.count("from_json(StructField") == 1
    assert text.count("from_json(ArrayType") == (layout == "array")


def test_category_maps_are_parsed_once(spark, write_json):
    path = write_json("categories.json", {"Rock": [{"id": "1"}]})
    assert plan(artists_from_categories(read_category_map(spark, path))).count("from_json(") == 1


def test_keep_first_cuts_each_group_before_the_shuffle(silver_tables):
    text = plan(dedup.keep_first(silver_tables, "id", ["duration_ms"]))
    partial = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(partial) == 2 and text.count("Exchange") == 1
    assert partial[0] < text.index("Exchange") < partial[1]
    assert ", Partial" in text and ", Final" in text


def test_large_n_is_cut_within_input_partitions_first(silver_tables):
    text = plan(ranking.first_n_per_parent(silver_tables, "album_id", ["id", "duration_ms"], 50_000))
    assert text.count("WindowGroupLimit") == 2 and text.count("Window [") == 1
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_statistics_read_the_tracks_once(silver_tables, spark):
    albums = spark.createDataFrame([("1", "one")], "id string, name string").select(
        F.col("id").alias("album_id"), "name", *[F.lit(None).cast("string").alias(c) for c in
        ("album_type", "release_date", "artist_ids", "genres", "label")],
        F.lit(1).cast("long").alias("total_tracks"), F.lit(2).cast("long").alias("popularity"),
    )
    assert plan(gold.albums_stats(silver_tables, albums)).count("FileScan") == 1
    hot = gold.albums_stats(silver_tables, albums, ["1"])
    assert "duration_ms" not in plan(hot)  # the statistics are read, not worked out again
    assert rows(hot) == rows(gold.albums_stats(silver_tables, albums))


def test_a_load_cuts_after_the_semi_join(spark):
    parents = spark.createDataFrame([("a", 1)], "id string, ord int")
    found = spark.createDataFrame([("a", 1, ("x",))], "parent_id string, ord int, item struct<id: string>")
    none = spark.createDataFrame([], "id string")
    keys = spark.createDataFrame([], "id string, status string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = increment.load(
            parents, found, none, keys, parent_order=["ord"], child_order=["ord"], per_parent=3, required=["id"]
        )
        text = plan(run.new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("WindowGroupLimit [parent_id") < text.rindex("LeftSemi")  # plans read from the bottom


def test_transforms_run_no_job(spark, silver_tables):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    ranking.seeded_sample(silver_tables, "id", 5)
    gold.album_groups(silver_tables)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_new_rows_shuffle_each_side_once(spark, silver_tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(dedup.new_rows(silver_tables, silver_tables, "id", ["duration_ms"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_stored_rows_stay_in_their_buckets(spark, tmp_path, silver_tables):
    """Only the candidates are shuffled; the stored ids are read bucket by bucket."""
    table = Bucketed(str(tmp_path / "stored"), "id string, name string", "id", 8)
    assert table.read(spark).count() == 0
    table.append(silver_tables.where("disc_number = 1 OR id LIKE '%1'"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = dedup.new_rows(silver_tables, table.read(spark), "id", ["duration_ms"])
        text = plan(fresh)
        exchanges = [m.start() for m in re.finditer("Exchange hashpartitioning", text)]
        scans = {m[1]: m.start() for m in re.finditer(r"FileScan parquet (\S*?)\[", text)}
        stored = next(at for name, at in scans.items() if "bucketed" in name)
        assert "Bucketed: true" in text[stored:] and "SelectedBucketsCount: 8 out of 8" in text
        # Plans read from the bottom: no exchange lies between the stored scan and the join above it.
        assert not any(text.index("LeftAnti") < at < stored and text[at:stored].count("FileScan") == 0 for at in exchanges)
        plain = dedup.new_rows(silver_tables, spark.read.parquet(str(tmp_path / "stored")), "id", ["duration_ms"])
        assert rows(fresh) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reading_a_date_opens_no_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-01-30", "2024-01-31"):
        replace_date(spark.range(5), path, day)
    read = read_date(spark, path, "2024-01-31")
    assert all("ingest_date=2024-01-31" in file for file in read.inputFiles())


@pytest.fixture
def skewed(spark):
    """Small thresholds, so that a few thousand rows count as a hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    yield spark.range(0, 40_000, numPartitions=8).select(hot.alias("key"), F.md5(F.col("id").cast("string")).alias("v"))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_children_of_one_parent_are_split(spark, skewed):
    parents = spark.createDataFrame([("hot", "2020"), ("1", "1999")], "key string, release_date string")
    joined = joins.inherit(skewed, parents, "key", "release_date")
    assert joined.where("release_date = '2020'").count() == 13_334
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)


@pytest.mark.parametrize("join", [joins.matching, joins.excluding])
def test_hot_keys_are_split_in_semi_and_anti_joins(spark, skewed, join):
    keys = spark.range(0, 20_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key")
    )
    joined = join(skewed, keys, "key")
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)
    total = joins.matching(skewed, keys, "key").count() + joins.excluding(skewed, keys, "key").count()
    assert total == 40_000


def test_hot_attribute_keys_are_split_without_being_named(spark, skewed):
    """A third of the attribute rows belong to one key that nobody names."""
    stats = spark.range(0, 50_000).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), F.lit(1).alias("n")
    )
    joined = joins.attach(stats, skewed, "key", None)
    assert joined.where("key = 'hot'").count() == 13_334
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.where("v IS NULL").count() == 50_000 - 1 - 26_666
    assert rows(joined.groupBy("key").count()) == rows(joins.attach(stats, skewed, "key").groupBy("key").count())


# Queries that write and read back, or run a job, before they return.
EAGER = {"step_metrics"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct|NestedLoop", text)


def test_the_library_calls_nothing_that_gathers_rows():
    root = Path(__file__).parent.parent / "discolake"
    allowed = {
        ("quality.py", "report.collect()"),  # one row per expected dataset
        ("__main__.py", "row.first()"),  # the summary of a run, one row
    }
    gathering = "collect|first|head|take|tail|toPandas|toLocalIterator|localCheckpoint|crossJoin|cache|persist"
    pattern = re.compile(rf"[\w)\]]+\.(?:{gathering})\(\)?")
    # The llm subpackage has Python stages and tests of its own, and may be absent.
    files = [f for f in root.rglob("*.py") if "llm" not in f.relative_to(root).parts]
    code = {f: re.sub(r"F\.(?:first|collect_\w+)\(", "", f.read_text()) for f in files}
    found = {(f.name, m) for f, text in code.items() for m in pattern.findall(text)}
    assert found <= allowed
    assert not any(re.search(r"udf|applyIn|mapIn|\.rdd\b", text) for text in code.values())
