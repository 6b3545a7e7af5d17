import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from discolake import schemas
from discolake.sources.documents import (
    CORRUPT,
    ORD,
    element_texts,
    if_present,
    read_category_map,
    read_documents,
    read_domain,
    read_stored,
)
from discolake.sources.manifests import read_keys, read_manifest_keys, settled
from discolake.sources.tables import read_date
from tests.conftest import order, rows

OWNERS = [
    {"display_name": 'tricky },\n  {  "x"', "id": "007", "type": "user"},
    {"display_name": None, "id": "é", "type": "user"},
    {"id": "3", "extra": {"deep": [{"a": 1}, {"b": [2, {}]}]}},
]
WANT = [(o.get("display_name"), o["id"], o.get("type")) for o in OWNERS]


@pytest.mark.parametrize("layout, indent", [("array", None), ("array", 2), ("indented", 2)])
def test_array_layouts(spark, write_json, layout, indent):
    path = write_json("owners.json", OWNERS, indent)
    assert rows(read_documents(spark, path, schemas.OWNER, layout)) == sorted(WANT, key=order)


def test_lines_layout(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(o) for o in OWNERS) + "\n\n")
    assert rows(read_documents(spark, str(path), schemas.OWNER, "lines")) == sorted(WANT, key=order)
    assert element_texts(spark, str(path), "lines").count() == 3


@pytest.mark.parametrize("layout, indent", [("array", None), ("indented", 2)])
def test_element_texts_lose_nothing(spark, write_json, layout, indent):
    path = write_json("owners.json", OWNERS, indent)
    texts = [r.value for r in element_texts(spark, path, layout).collect()]
    assert [json.loads(t) for t in texts] == OWNERS
    assert not any("\n" in t for t in texts)


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_empty_and_single_arrays(spark, write_json, layout):
    assert read_documents(spark, write_json("none.json", []), schemas.OWNER, layout).count() == 0
    one = read_documents(spark, write_json("one.json", OWNERS[:1]), schemas.OWNER, layout)
    assert rows(one) == WANT[:1]


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_other_layouts_are_refused_as_indented(spark, write_json, indent):
    path = write_json("owners.json", OWNERS, indent)
    with pytest.raises(Exception, match="not an array indented by two spaces"):
        read_documents(spark, path, schemas.OWNER, "indented").collect()


def test_null_elements_are_refused_as_indented(spark, write_json):
    path = write_json("owners.json", [OWNERS[0], None, OWNERS[2]])
    with pytest.raises(Exception, match="not an array indented by two spaces"):
        read_documents(spark, path, schemas.OWNER, "indented").collect()


def test_null_elements_of_an_array_lose_no_neighbours(spark, write_json):
    path = write_json("owners.json", [OWNERS[0], None, OWNERS[1]], None)
    docs = read_documents(spark, path, schemas.OWNER, "array", ordered=True)
    assert [r.id for r in docs.orderBy(ORD).collect()] == [OWNERS[0]["id"], None, OWNERS[1]["id"]]
    assert [r.value for r in element_texts(spark, path, "array").collect()][1] == "null"


def test_a_broken_array_raises(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('[{"id": "1"}, {"id": "2"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_documents(spark, str(path), schemas.OWNER, "array").collect()


def test_a_lone_object_is_one_document(spark, write_json):
    assert rows(read_documents(spark, write_json("one.json", OWNERS[0]), schemas.OWNER, "array")) == WANT[:1]


@pytest.mark.parametrize("layout", ["array", "indented", "lines"])
def test_positions_follow_the_file(spark, tmp_path, write_json, layout):
    docs = [{"id": str(i)} for i in range(50)]
    path = write_json("owners.json", docs)
    if layout == "lines":
        (tmp_path / "owners.json").write_text("\n".join(json.dumps(d) for d in docs))
    df = read_documents(spark, path, schemas.OWNER, layout, ordered=True)
    assert [r.id for r in df.orderBy(ORD).collect()] == [d["id"] for d in docs]
    assert df.schema[ORD].dataType.simpleString() == "struct<file:string,block:bigint,row:bigint>"


def test_a_large_indented_file_is_read_by_many_tasks(spark, write_json):
    docs = [{"id": str(i), "display_name": "}, {" * (i % 50), "type": "user"} for i in range(3000)]
    path = write_json("owners.json", docs)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = read_documents(spark, path, schemas.OWNER, "indented", ordered=True)
        assert df.select(F.spark_partition_id()).distinct().count() > 10
        got = [r.id for r in df.orderBy(ORD).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [str(i) for i in range(3000)]


@pytest.mark.parametrize("layout", ["indented", "lines", "array"])
def test_values_that_do_not_fit_are_null_and_can_be_counted(spark, tmp_path, write_json, layout):
    docs = [{"id": "1", "popularity": 5}, {"id": "2", "popularity": "many"}, {"id": 3, "popularity": 1}]
    path = write_json("albums.json", docs)
    if layout == "lines":
        (tmp_path / "albums.json").write_text("\n".join(json.dumps(d) for d in docs))
    df = read_documents(spark, path, schemas.ALBUM, layout, corrupt=True)
    assert rows(df, "id", "popularity") == [("1", 5), ("2", None), ("3", 1)]
    assert df.cache().where(F.col(CORRUPT).isNotNull()).count() == 1


def test_declared_schema_keeps_numeric_ids_as_text(spark, write_json):
    path = write_json("artists.json", [{"id": "007"}, {"id": "42"}])
    assert rows(read_documents(spark, path, schemas.ARTIST), "id") == [("007",), ("42",)]


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_read_domain_passes_over_the_manifest(spark, tmp_path, write_json, layout):
    write_json("albums/ingest_date=2024-01-31/albums.json", [{"id": "a"}])
    write_json("albums/ingest_date=2024-01-31/albums_processing_metadata.json", {"total_albums": 1})
    write_json("albums/ingest_date=2024-02-01/albums.json", [{"id": "b"}])
    df = read_domain(spark, str(tmp_path), "albums", "2024-01-31", schemas.ALBUM, layout)
    assert rows(df, "id") == [("a",)]


CATEGORIES = {
    "Empty": [],
    "Rock": [{"id": "1", "name": "a } ] b", "genres": ["x", "y"], "followers": {"total": 3}}, {"id": "2"}],
    "None": [],
    "Pop": [{"id": "1", "genres": []}],
    "Last": [],
}


@pytest.mark.parametrize("layout", ["whole", "indented"])
@pytest.mark.parametrize("names", [list(CATEGORIES), ["Rock", "Pop"], ["Rock"], ["Empty"], ["Pop", "Last"]])
def test_category_map(spark, write_json, layout, names):
    from discolake.plans.bronze import flatten_categories

    path = write_json("categories.json", {name: CATEGORIES[name] for name in names})
    flat = flatten_categories(read_category_map(spark, path, layout))
    want = [(name, pos, a["id"]) for name in names for pos, a in enumerate(CATEGORIES[name])]
    assert rows(flat, "category", "pos", "id") == sorted(want, key=order)


def test_stored_output(spark, tmp_path, write_json):
    assert read_stored(spark, str(tmp_path / "nothing"), schemas.OWNER).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_stored(spark, str(bad), schemas.KEYS, format="parquet").collect()


def test_stored_json_that_is_damaged_raises(spark, tmp_path):
    (tmp_path / "owners.json").write_text('{"id": "1"}\ngarbage\n{"id":\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_stored(spark, str(tmp_path / "owners.json"), schemas.OWNER).collect()


@pytest.mark.parametrize("layout", ["array", "indented", "lines"])
def test_damaged_manifests_raise(spark, tmp_path, write_json, layout):
    whole = json.dumps({"processed_albums": ["a", "b"], "total_tracks": 2}, indent=None if layout == "lines" else 2)
    for name, text in {"cut": whole[: len(whole) // 2], "garbage": "nonsense\n" + whole[3:]}.items():
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="MALFORMED_RECORD|not a whole manifest"):
            read_manifest_keys(spark, str(tmp_path / name), "processed_albums", layout).collect()


def test_an_indented_manifest_of_another_shape_raises(spark, write_json):
    for name, value, indent in [
        ("wide", {"processed_albums": ["a"]}, 4),
        ("flat", {"processed_albums": ["a"]}, None),
        ("other", {"processed_artists": ["a"]}, 2),
        ("two", {"processed_albums": ["a"], "processed_artists": ["b"]}, 2),
    ]:
        path = write_json(name, value, indent)
        with pytest.raises(Exception, match="not a whole manifest"):
            read_manifest_keys(spark, path, "processed_albums").collect()


def test_if_present_raises_on_other_errors(spark, tmp_path):
    assert if_present(spark.read.text, str(tmp_path / "nothing")) is None
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        if_present(lambda path: spark.read.parquet(path).select("nothing"), str(tmp_path / "t"))


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_manifest_keys(spark, tmp_path, write_json, layout):
    keys = ["b", "a", "a", 'q"\\uote', "é"]
    manifest = {"processed_albums": keys, "total_tracks": 5, "last_update": "2024-01-31 00:00:00", "status": "completed"}
    path = write_json("m.json", manifest)
    assert rows(read_manifest_keys(spark, path, "processed_albums", layout)) == sorted({(k,) for k in keys}, key=order)
    empty = write_json("e.json", {"processed_albums": [], "total_tracks": 0})
    absent = write_json("n.json", {"total_tracks": 0})
    for file in (empty, absent, str(tmp_path / "missing.json")):
        assert read_manifest_keys(spark, file, "processed_albums", layout).count() == 0


def test_settled_keys_leave_out_retries(spark, tmp_path):
    assert read_keys(spark, str(tmp_path / "none")).count() == 0
    keys = spark.createDataFrame([("a", "done"), ("b", "retry"), ("c", "empty"), ("d", "failed")], schemas.KEYS)
    assert rows(settled(keys)) == [("a",), ("c",), ("d",)]


def test_read_date(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-31"), ("b", "2024-02-01")], "id string, ingest_date string")
    df.write.partitionBy("ingest_date").parquet(str(tmp_path / "t"))
    out = read_date(spark, str(tmp_path / "t"), "2024-02-01")
    assert [(r.id, str(r.ingest_date)) for r in out.collect()] == [("b", "2024-02-01")]
    with pytest.raises(AnalysisException):
        read_date(spark, str(tmp_path / "t"), "2024-03-01")
