"""Arrays in any format, cut at their braces and read by many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from discolake.sources.documents import read_documents
from tests.conftest import rows

SCHEMA = "id string, name string, inner struct<id: string, list: array<struct<x: long>>>"


def values(draw, depth=0):
    """Any JSON value, with signs of structure within its strings."""
    kind = draw.randint(0, 7 if depth < 3 else 4)
    text = "".join(draw.choices('ab{}[],:"\\ \n\té', k=draw.randint(0, 12)))
    if kind < 5:
        return [text, draw.randint(-5, 5), None, True, f"{text}\\"][kind]
    if kind == 5:
        return [values(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return {f"k{i}": values(draw, depth + 1) for i in range(draw.randint(0, 4))}


def texts(spark, path, layout, ordered=False):
    from discolake.sources.documents import SCANS

    found = SCANS[layout](spark, path, ordered)
    return [r.value for r in (found.orderBy("ord") if ordered else found).collect()]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 0, 1, 2])
def test_any_format_gives_the_elements_in_order(spark, tmp_path, small_splits, indent):
    draw = random.Random(indent or 7)
    listed = [values(draw) for _ in range(400)] + [{"long": "x{" * 4000}, None, [], {}, "}"]
    (tmp_path / "a.json").write_text(json.dumps(listed, indent=indent, ensure_ascii=False))
    found = texts(spark, str(tmp_path / "a.json"), "any", ordered=True)
    assert [None if t is None else json.loads(t) for t in found] == listed
    assert found == texts(spark, str(tmp_path / "a.json"), "array", ordered=True)


def test_many_tasks_share_a_file_without_line_breaks(spark, tmp_path, small_splits):
    docs = [{"id": str(i), "name": 'a "quoted" {name}', "inner": {"id": "}", "list": [{"x": i}, {"x": 2}]}} for i in range(2000)]
    path = str(tmp_path / "a.json")
    (tmp_path / "a.json").write_text(json.dumps(docs, separators=(",", ":")))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    found = read_documents(spark, path, SCHEMA, "any")
    assert found.agg(F.count("id"), F.sum(F.col("inner.list")[0]["x"])).first() == (2000, sum(range(2000)))
    assert rows(found) == rows(read_documents(spark, path, SCHEMA, "array"))


def test_several_files_lone_objects_and_empty_ones(spark, tmp_path):
    for name, text in {
        "a": '[{"id":"1"},{"id":"2"}]', "b": '{"id":"3","inner":{"id":"x","list":[{"x":1}]}}', "c": ' {"id":"4"}\n',
        "d": "", "e": " \n", "f": "[]", "g": " [ ] \n", "h": '[null, {"id":"5"}, null]', "i": "[{}]\n",
        "j": '{"id":"6","inner":{}\n}', "k": '{"id":"7","inner":{}}\n\n', "l": "{}",
    }.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = read_documents(spark, str(tmp_path), SCHEMA, "any")
    assert rows(found, "id") == [(None,)] * 4 + [(str(i),) for i in range(1, 8)]


@pytest.mark.parametrize(
    "text",
    ['[{"id":"1"}', '[{"id":"1"', '[{"id":"1}]', '[{"id":"1"}]]', '[{"id":"1"} {"id":"2"}]', '[{"id":"1"},]', '[{"id":"1"}],{"id":"2"}',
     '{"id":"1"}{"id":"2"}', '[{"id":"1"},,{"id":"2"}]', '[{"id" "1"}]', '[]}', '[{"id":"1"}]}', '{"id":"1"}}', '{"id":"1"} x'],
)
def test_a_broken_file_raises(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not a whole JSON array|MALFORMED|malformed|PARSE"):
        read_documents(spark, str(tmp_path / "a.json"), SCHEMA, "any").collect()
