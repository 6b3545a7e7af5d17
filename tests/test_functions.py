import datetime

import pytest
from pyspark.sql import functions as F

from discolake.functions import arrays, scalars


@pytest.fixture
def one(spark):
    """Evaluate an expression on one row."""

    def evaluate(schema, value, build):
        df = spark.createDataFrame([(value,)], f"c {schema}")
        return df.select(build(F.col("c")).alias("out")).first()["out"]

    return evaluate


ARTISTS = "array<struct<id: string>>"


@pytest.mark.parametrize(
    "value, want",
    [
        (None, None),
        ([], ""),
        ([("a",)], "a"),
        ([("a",), ("b",)], "a,b"),
        ([("a",), ("a",)], "a,a"),
        ([("a",), (None,)], "a"),
        ([(None,)], ""),
    ],
)
def test_ids_to_csv(one, value, want):
    assert one(ARTISTS, value, arrays.ids_to_csv) == want


@pytest.mark.parametrize(
    "value, want",
    [(None, None), ([], ""), (["x", "y"], "x,y"), (["x", None], "x,None")],
)
def test_values_to_csv(one, value, want):
    assert one("array<string>", value, arrays.values_to_csv) == want


NOTICES = "array<struct<text: string, type: string>>"


@pytest.mark.parametrize(
    "value, want",
    [
        (None, None),
        ([], None),
        ([("p", "P")], None),
        ([("p", "P"), ("c", "C")], "c"),
        ([("c1", "C"), ("c2", "C")], "c1"),
        ([(None, "C"), ("c2", "C")], None),
    ],
)
def test_first_where(one, value, want):
    assert one(NOTICES, value, lambda c: arrays.first_where(c, "type", "C", "text")) == want


@pytest.mark.parametrize("value, want", [(None, None), ([], None), ([("a",), ("b",)], "a")])
def test_first_field(one, value, want):
    assert one(ARTISTS, value, lambda c: arrays.first_field(c, "id")) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("2020-01-02", datetime.date(2020, 1, 2)),
        ("2020-05", datetime.date(2020, 5, 1)),
        ("2020", datetime.date(2020, 1, 1)),
        ("N/A", None),
        ("", None),
        (None, None),
    ],
)
def test_release_date(one, value, want):
    assert one("string", value, scalars.release_date) == want


@pytest.mark.parametrize("value, sec, minute", [(90_000, 90.0, 1.5), (0, 0.0, 0.0), (None, None, 0.0)])
def test_durations(one, value, sec, minute):
    assert one("long", value, scalars.seconds) == sec
    assert one("long", value, scalars.minutes) == minute


@pytest.mark.parametrize("value, want", [("a", True), ("", False), (None, False)])
def test_truthy_is_never_null(one, value, want):
    assert one("string", value, scalars.truthy) is want


def test_genre_key_and_default(one):
    assert one("string", "Hip-Hop", scalars.genre_key) == "hip-hop"
    assert one("string", None, lambda c: scalars.with_default(c, "Unknown")) == "Unknown"
    assert one("string", "x", lambda c: scalars.with_default(c, "Unknown")) == "x"


def test_iso_text_has_microseconds_and_no_zone(one):
    moment = datetime.datetime(2024, 3, 4, 5, 6, 7, 89)
    text = one("timestamp", moment, scalars.iso_text)
    assert datetime.datetime.fromisoformat(text) == moment


def test_iso_now_is_iso(spark):
    text = spark.range(1).select(scalars.iso_now().alias("t")).first()["t"]
    assert datetime.datetime.fromisoformat(text).tzinfo is None


def test_json_text_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "id string, name string")
    assert df.select(scalars.json_text("id", "name")).first()[0] == '{"id":"a","name":null}'
