import json

import pytest
from pyspark.sql import functions as F

from discolake import __main__ as cli
from discolake.operators.dedup import keep_first
from discolake.sources.topics import read_message_files
from discolake.streaming import events
from tests.conftest import order, rows


@pytest.fixture
def topic(tmp_path):
    """A folder of message files; each call adds one file."""
    folder = tmp_path / "topic"
    folder.mkdir()

    def send(name, *messages):
        text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
        (folder / name).write_text(text + "\n")
        return str(folder)

    return send


def event(id, time="2024-01-10T00:00:00.000001", **more):
    return {"id": id, "name": f"n{id}", "artist": None, "timestamp": time, **more}


def land(spark, folder, tmp_path):
    query = events.land(read_message_files(spark, folder), str(tmp_path / "bronze"), str(tmp_path / "cp1"))
    query.awaitTermination()
    return spark.read.schema(events.EVENT).parquet(str(tmp_path / "bronze"))


def dedup(spark, tmp_path, delay="1 day", slices=1, **trigger):
    stream = spark.readStream.schema(events.EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "bronze"))
    kept = events.deduplicate(stream, delay, slices=slices)
    query = events.append_to(kept, str(tmp_path / "silver"), str(tmp_path / "cp2"), **trigger)
    query.awaitTermination()
    return query, spark.read.schema(events.EVENT).parquet(str(tmp_path / "silver"))


def test_landing_drops_only_events_without_an_id(spark, topic, tmp_path):
    folder = topic("1", event("1"), event(""), {"name": "x"}, "not json", event("1"), event("2", "1999-01-01T00:00:00"))
    landed = land(spark, folder, tmp_path)
    assert rows(landed, "id") == [("1",), ("1",), ("2",)]
    # Nothing is dropped for being late, and a restart adds only what is new.
    topic("2", event("3", "1990-01-01T00:00:00"))
    assert rows(land(spark, folder, tmp_path), "id") == [("1",), ("1",), ("2",), ("3",)]


@pytest.mark.parametrize("slices", [1, 4])
def test_stream_dedup_equals_batch_dedup(spark, topic, tmp_path, slices):
    for file in "abc":
        folder = topic(file, *[event(str(i % 7), f"2024-01-10T00:00:0{i % 3}") for i in range(60)])
    landed = land(spark, folder, tmp_path)
    query, silver = dedup(spark, tmp_path, slices=slices)
    assert rows(silver) == rows(keep_first(landed, ["id", "timestamp"], ["name"]))
    assert silver.count() == 21 and events.late_rows(query) == 0


def test_restart_adds_nothing_and_new_repeats_are_known(spark, topic, tmp_path):
    folder = topic("1", event("1"), event("2"))
    land(spark, folder, tmp_path)
    dedup(spark, tmp_path)
    _, silver = dedup(spark, tmp_path)
    assert rows(silver, "id") == [("1",), ("2",)]
    topic("2", event("1"), event("1", "2024-01-10T00:00:02"), event("3"))
    land(spark, folder, tmp_path)
    _, silver = dedup(spark, tmp_path)
    assert rows(silver, "id") == [("1",), ("1",), ("2",), ("3",)]


def test_rows_behind_the_watermark_are_counted(spark, topic, tmp_path):
    folder = topic("1", event("1", "2024-01-10T00:00:00"))
    land(spark, folder, tmp_path)
    dedup(spark, tmp_path)
    topic("2", event("2", "2024-01-01T00:00:00"), event("3", "2024-01-09T12:00:00"))
    land(spark, folder, tmp_path)
    query, silver = dedup(spark, tmp_path)
    assert rows(silver, "id") == [("1",), ("3",)]
    assert events.late_rows(query) == 1


def test_an_unreadable_time_costs_no_good_event(spark, topic, tmp_path):
    good = [event(str(i), f"2024-01-{10 + i // 5:02}T00:00:00") for i in range(15)]
    for i, part in enumerate((good[:5], [*good[5:9], event("bad", "not a time"), event("bad", "not a time")], good[9:])):
        folder = topic(f"{i}", *part)
        land(spark, folder, tmp_path)
        query, silver = dedup(spark, tmp_path)
        assert events.late_rows(query) == 0
    assert rows(silver, "id") == sorted((str(i),) for i in range(15))
    aside = events.untimed(spark.read.schema(events.EVENT).parquet(str(tmp_path / "bronze")))
    assert rows(keep_first(aside, ["id", "timestamp"], ["id"]), "id", "timestamp") == [("bad", "not a time")]


def test_rejected_messages_have_a_place(spark):
    texts = ['{"id": "1"}', '{"id": ""}', '{"name": "x"}', "garbage", '{"id": "2"', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(events.decode(df), "id") == [("1",)]
    assert rows(events.rejected(df)) == sorted(((t,) for t in texts[1:]), key=order)


def test_one_event_sent_very_often_is_split(spark, topic, tmp_path):
    """The first step sees the copies in several tasks, the second a few."""
    for i in range(6):
        folder = topic(f"f{i}", *[event("hot")] * 200)
    land(spark, folder, tmp_path)
    stream = spark.readStream.schema(events.EVENT).parquet(str(tmp_path / "bronze"))
    query = events.append_to(events.deduplicate(stream, slices=16), str(tmp_path / "silver"), str(tmp_path / "cp2"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 1
    steps = [p.stateOperators for p in query.recentProgress if p.numInputRows][0]
    assert sorted(step.numRowsUpdated for step in steps)[0] == 1
    assert max(step.numRowsUpdated for step in steps) > 1


def test_decode_takes_binary_values(spark):
    df = spark.createDataFrame([(bytearray(b'{"id": "1", "popularity": 5}'),)], "value binary")
    assert events.decode(df).select("id", "popularity").first().asDict() == {"id": "1", "popularity": 5}
    assert events.decode(df.where(F.lit(False))).count() == 0


def test_a_time_far_ahead_costs_no_good_event(spark, topic, tmp_path):
    """One event of 2099 among good ones; without the second clock five of these were dropped."""
    good = [event(str(i), f"2024-01-{10 + i:02}T00:00:00") for i in range(15)]
    future = event("future", "2099-01-01T00:00:00")
    for i, part in enumerate((good[:5], [*good[5:9], future], good[9:])):
        folder = topic(f"{i}", *part)
        land(spark, folder, tmp_path)
        bronze = str(tmp_path / "bronze")
        stream = events.with_arrival(spark.readStream.schema(events.EVENT).parquet(bronze))
        query = events.append_to(events.deduplicate(stream, "1 hour"), str(tmp_path / "silver"), str(tmp_path / "cp2"))
        assert sum(events.follow(query, 0.5).values()) == 0
    silver = spark.read.schema(events.EVENT).parquet(str(tmp_path / "silver"))
    assert rows(silver, "id") == sorted((str(i),) for i in range(15))
    landed = events.with_arrival(spark.read.schema(events.EVENT).parquet(str(tmp_path / "bronze")))
    assert rows(events.set_aside(landed), "id", "reason") == [("future", "ahead")]


def test_a_skew_is_allowed_and_an_unknown_arrival_believed(spark):
    rows_ = [("a", "2024-01-10T00:59:00"), ("b", "2024-01-10T01:01:00"), ("c", None), ("d", "no")]
    df = spark.createDataFrame(rows_, "id string, timestamp string")
    clock = F.lit("2024-01-10T00:00:00").cast("timestamp")
    seen = events.with_arrival(df, clock)
    assert rows(events.timed(seen), "id") == [("a",)]
    assert rows(events.timed(seen, "2 hours"), "id") == [("a",), ("b",)]
    assert rows(events.set_aside(seen), "id", "reason") == [("b", "ahead"), ("c", "unreadable"), ("d", "unreadable")]
    unknown = events.with_arrival(df, F.lit(None).cast("timestamp"))
    assert rows(events.timed(unknown), "id") == rows(events.timed(df), "id") == [("a",), ("b",)]


def test_late_rows_are_counted_per_batch_and_found_again(spark, topic, tmp_path):
    """More batches than Spark keeps progress of; every one is counted."""
    bronze = str(tmp_path / "bronze")
    folder = topic("000", event("new", "2024-03-01T00:00:00"))
    land(spark, folder, tmp_path)
    dedup(spark, tmp_path)
    for i in range(8):
        topic(f"{i + 1:03}", event(f"late {i}", "2024-01-01T00:00:00"), event(f"late {i}", "2024-01-01T00:00:00"))
        land(spark, folder, tmp_path)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream = spark.readStream.schema(events.EVENT).option("maxFilesPerTrigger", 1).parquet(bronze)
        query = events.append_to(events.deduplicate(stream), str(tmp_path / "silver"), str(tmp_path / "cp2"))
        dropped = events.follow(query, 0.1)
        assert events.late_rows(query) < 16
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sum(dropped.values()) == 16 and len(dropped) >= 8
    silver, landed = (spark.read.schema(events.EVENT).parquet(str(tmp_path / x)) for x in ("silver", "bronze"))
    lost = events.lost_events(landed, silver)
    assert rows(lost, "id") == [(f"late {i}",) for i in range(8)]
    assert rows(silver.unionByName(lost)) == rows(events.rebuild(landed))


def test_rebuild_from_the_command_line(spark, topic, tmp_path, capsys):
    folder = topic("1", event("1"), event("1"), event("2", "x"), event("2", "x"), event("3", "2999-01-01"), event("4", None))
    land(spark, folder, tmp_path)
    paths = [str(tmp_path / name) for name in ("bronze", "silver", "aside")]
    for _ in range(2):
        cli.main(["rebuild-events", "--source", paths[0], "--target", paths[1], "--untimed", paths[2]])
    assert "events: 1, set aside: 3" in capsys.readouterr().out
    assert rows(spark.read.parquet(paths[1]), "id") == [("1",)]
    assert rows(spark.read.parquet(paths[2]), "id", "reason") == [("2", "unreadable"), ("3", "ahead"), ("4", "unreadable")]
    cli.main(["dedup-events", "--source", paths[0], "--target", f"{paths[1]}2", "--untimed", f"{paths[2]}2",
              "--checkpoint", str(tmp_path / "cp3")])
    assert "late rows dropped: 0" in capsys.readouterr().out
    assert rows(spark.read.parquet(f"{paths[1]}2"), "id") == [("1",)]
