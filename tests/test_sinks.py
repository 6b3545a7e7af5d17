import csv
import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from discolake.sinks import exports, staging, tables, topics
from tests.conftest import rows


def dates(spark, path):
    return rows(spark.read.parquet(path).withColumn("ingest_date", F.col("ingest_date").cast("string")))


def test_replace_date_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a",), ("b",)], "id string")
    assert tables.replace_date(one, path, "2024-01-30") == 2
    assert tables.replace_date(one, path, "2024-01-31") == 2
    for _ in range(2):  # a rerun changes nothing
        assert tables.replace_date(spark.createDataFrame([("c",)], "id string"), path, "2024-01-31") == 1
    assert dates(spark, path) == [("a", "2024-01-30"), ("b", "2024-01-30"), ("c", "2024-01-31")]


@pytest.mark.parametrize("how", ["filter", "local"])
def test_replace_date_with_nothing_empties_that_date(spark, tmp_path, how):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([("a",), ("b",)], "id string")
    tables.replace_date(full, path, "2024-01-30")
    tables.replace_date(full, path, "2024-01-31")
    nothing = full.where("id > 'z'") if how == "filter" else spark.createDataFrame([], "id string")
    assert tables.replace_date(nothing, path, "2024-01-31") == 0
    assert dates(spark, path) == [("a", "2024-01-30"), ("b", "2024-01-30")]


def test_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        tables.overwrite(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def test_overwrite_by_year_keeps_dates_and_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    day = datetime.date
    df = spark.createDataFrame(
        [("a", day(2020, 1, 2)), ("b", day(2020, 5, 1)), ("c", day(1999, 1, 1)), ("d", None)],
        "id string, release_date date",
    )
    tables.overwrite_by_year(df.repartition(4), path)
    folders = sorted(p.name for p in Path(path).glob("release_year=*"))
    assert folders == ["release_year=1999", "release_year=2020", "release_year=__HIVE_DEFAULT_PARTITION__"]
    # One file per folder, although four tasks held rows.
    assert len(list(Path(path).glob("*/*.parquet"))) == 3
    back = spark.read.parquet(path)
    assert rows(back.select("id", "release_date")) == rows(df)


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        year = F.when(F.col("id") % 3 == 0, 1990 + F.col("id") % 30).otherwise(2020)
        day = F.make_date(year.cast("int"), F.lit(1), F.lit(1))
        rows_ = spark.range(0, 20_000, numPartitions=8)
        df = rows_.select(F.md5(F.col("id").cast("string")).alias("id"), day.alias("release_date"))
        tables.overwrite_by_year(df, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "release_year=2020").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_csv_export_has_a_header(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 'say "hi", ok', None), ("b", "", 2.5), ("c", "  padded  ", 1.0), ("d", "two\nlines \\", 0.0)],
        "id string, name string, v double",
    )
    exports.export_csv(df.coalesce(1), str(tmp_path / "csv"))
    (file,) = (tmp_path / "csv").glob("*.csv")
    back = list(csv.reader(file.open(newline="")))
    assert back == [
        ["id", "name", "v"], ["a", 'say "hi", ok', ""], ["b", "", "2.5"],
        ["c", "  padded  ", "1.0"], ["d", "two\nlines \\", "0.0"],
    ]


def test_export_tables_keeps_the_tree(spark, tmp_path):
    source, target = str(tmp_path / "gold"), tmp_path / "copy"
    for date in ("2024-01-30", "2024-01-31"):
        tables.replace_date(spark.range(3), f"{source}/artists_stats", date)
        tables.replace_date(spark.range(2), f"{source}/albums_stats", date)
    exports.export_tables(spark, source, str(target), ["artists_stats", "albums_stats"])
    folders = sorted(str(p.relative_to(target)) for p in target.glob("*/ingest_date=*"))
    assert folders == [f"{t}/ingest_date=2024-01-{d}" for t in ("albums_stats", "artists_stats") for d in (30, 31)]
    assert spark.read.parquet(str(target / "artists_stats")).count() == 6


def test_documents_keep_null_fields(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "id string, name string")
    exports.write_documents(df.coalesce(1), str(tmp_path / "docs"))
    (file,) = (tmp_path / "docs").glob("part-*.json")
    assert [json.loads(line) for line in file.read_text().splitlines()] == [{"id": "é", "name": None}]


def test_topic_messages(spark):
    df = spark.createDataFrame([("1", "é", None)], "id string, name string, popularity long")
    encoded = topics.encode(df)
    assert encoded.columns == ["value"]
    assert json.loads(encoded.first()["value"]) == {"id": "1", "name": "é", "popularity": None}


def test_topic_options_ask_for_all_replicas():
    options = topics.topic_options("host:9092", "t")
    assert options["kafka.acks"] == "all" and options["kafka.retries"] == "3"
    assert options["topic"] == "t"


def test_a_failed_check_or_write_leaves_all_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.overwrite(spark.range(3), path) == 3

    def refuse(rows):
        raise ValueError(f"{rows} rows")

    with pytest.raises(ValueError, match="7 rows"):
        tables.overwrite(spark.range(7), path, check=refuse)
    with pytest.raises(Exception, match="broken"):
        tables.overwrite(spark.range(7).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    with pytest.raises(ValueError, match="5 rows"):
        tables.replace_date(spark.range(5), path, "2024-01-31", check=refuse)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(4), path)
    assert tables.overwrite(spark.read.parquet(path).where("id > 1"), path) == 2
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_a_publish_that_was_cut_off_is_undone(spark, tmp_path):
    """Between its renames a publish has moved the old table away; the next one brings it back."""
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(4), path)
    (tmp_path / "t").rename(tmp_path / "_old-t")
    staging.restore(spark, path)
    assert spark.read.parquet(path).count() == 4
    (tmp_path / "t").rename(tmp_path / "_old-t")
    staged = staging.stage(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4
    staging.publish(spark, staged)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]
