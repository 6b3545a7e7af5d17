import pytest

from discolake import __main__ as cli
from discolake.plans import layers
from discolake.schemas import ARTIST
from discolake.sinks.tables import overwrite, replace_date
from discolake.sources.documents import read_domain
from tests.conftest import rows
from tests.test_bronze import crawl  # noqa: F401


def test_run_layer_tries_every_dataset():
    def fail():
        raise KeyError("album")

    with pytest.raises(layers.LayerFailed, match="b: KeyError") as caught:
        layers.run_layer({"a": lambda: 1, "b": fail, "c": lambda: 3})
    assert [(r.dataset, r.rows, r.error is None) for r in caught.value.results] == [
        ("a", 1, True), ("b", None, False), ("c", 3, True),
    ]
    assert [r.rows for r in layers.run_layer({"a": lambda: 1, "c": lambda: None})] == [1, None]


def test_one_missing_domain_fails_the_layer_but_not_the_others(spark, tmp_path, crawl):  # noqa: F811
    from discolake.plans import bronze

    (crawl / "artists.json").unlink()
    source, target = str(tmp_path / "bronze"), str(tmp_path / "silver")
    bronze.land(spark, str(crawl), source, "2024-01-31", gated=False)
    with pytest.raises(layers.LayerFailed, match="artists"):
        layers.build_silver(spark, source, target, "2024-01-31")
    assert spark.read.parquet(f"{target}/playlists").count() == 1
    with pytest.raises(layers.LayerFailed, match="artists_stats") as caught:
        layers.build_gold(spark, target, str(tmp_path / "gold"), "2024-01-31")
    assert [r.rows for r in caught.value.results] == [None, 1]


def test_the_whole_chain_from_the_command_line(spark, tmp_path, crawl, capsys):  # noqa: F811
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    day = ["--date", "2024-01-31"]
    cli.main(["validate", "--source", str(crawl)])
    cli.main(["land", "--source", str(crawl), "--bronze", bronze, *day])
    cli.main(["silver", "--bronze", bronze, "--silver", silver, *day])
    cli.main(["links", "--bronze", bronze, "--silver", f"{silver}-links", *day])
    cli.main(["gold", "--silver", silver, "--gold", gold, *day])
    cli.main(["export-csv", "--silver", silver, "--target", str(tmp_path / "csv"), *day])
    cli.main(["export-gold", "--gold", gold, "--target", str(tmp_path / "copy")])
    cli.main(["owners", "--playlists", str(crawl / "playlists.json"), "--target", str(tmp_path / "owners")])
    assert "albums_stats" in capsys.readouterr().out
    artists = spark.read.parquet(f"{gold}/artists_stats")
    assert rows(artists, "artist_id", "track_count", "artist_name") == [("x", 1, "X")]
    assert str(artists.first()["ingest_date"]) == "2024-01-31"
    albums = spark.read.parquet(str(tmp_path / "copy" / "albums_stats"))
    assert rows(albums, "album_id", "total_duration_sec") == [("a", 1.0)]
    links = spark.read.parquet(f"{silver}-links/track_artists")
    assert rows(links, "track_id", "album_id", "artist_id") == [("t", "a", "x")]
    assert spark.read.parquet(f"{silver}-links/album_artists").columns[-1] == "release_year"
    csv = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert rows(csv, "id", "album_id", "duration_sec") == [("t", "a", "1.0")]
    assert rows(spark.read.json(str(tmp_path / "owners")), "id") == [("o",)]


def test_derived_owners_and_artists_can_be_landed(spark, tmp_path, crawl, write_json):  # noqa: F811
    categories = write_json("categories.json", {"Rock": [{"id": "x", "name": "X"}, {"id": "y"}], "Pop": []})
    for name in ("owners", "artists"):
        (crawl / f"{name}.json").unlink()
    cli.main(["owners", "--playlists", str(crawl / "playlists.json"), "--target", str(crawl / "owners.json")])
    cli.main(["artists", "--categories", categories, "--target", str(crawl / "artists.json")])
    lines = ["--lines", "owners", "artists"]
    cli.main(["validate", "--source", str(crawl), *lines])
    cli.main(["land", "--source", str(crawl), "--bronze", str(tmp_path / "b"), "--date", "2024-01-31", *lines])
    docs = read_domain(spark, str(tmp_path / "b"), "artists", "2024-01-31", ARTIST)
    assert rows(docs, "id", "name") == [("x", "X"), ("y", None)]


@pytest.mark.parametrize("layout", ["array", "indented"])
def test_silver_reads_uploaded_array_files(spark, tmp_path, write_json, layout):
    for domain, doc in {
        "tracks": {"id": "t", "album": {"id": "a"}, "artists": [{"id": "x"}]},
        "albums": {"id": "a", "artists": [], "copyrights": []},
        "artists": {"id": "x"},
        "owners": {"id": "o"},
        "playlists": {"id": "p"},
    }.items():
        write_json(f"bronze/{domain}/ingest_date=2024-01-31/{domain}.json", [doc])
    results = layers.build_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "2024-01-31", layout)
    assert [(r.dataset, r.rows) for r in results] == [
        ("tracks", 1), ("albums", 1), ("artists", 1), ("owners", 1), ("playlists", 1),
    ]


def test_damaged_documents_are_counted_and_refused(spark, tmp_path, write_json):
    for domain in ("albums", "artists", "owners", "playlists"):
        write_json(f"bronze/{domain}/ingest_date=2024-01-31/d.json", {"id": "1"}, None)
    folder = tmp_path / "bronze" / "tracks" / "ingest_date=2024-01-31"
    folder.mkdir(parents=True)
    (folder / "t.json").write_text('{"id":"1"}\n{"id":"2","album":\n{"id":"3","popularity":"high"}\n')
    paths = str(tmp_path / "bronze"), str(tmp_path / "silver")
    with pytest.raises(layers.LayerFailed, match="tracks: DamagedDocuments: 2 damaged") as caught:
        layers.build_silver(spark, *paths, "2024-01-31")
    assert [(r.dataset, r.rows, r.damaged) for r in caught.value.results][0] == ("tracks", 1, 2)
    results = layers.build_silver(spark, *paths, "2024-01-31", tolerance=2)
    assert [(r.rows, r.damaged) for r in results] == [(1, 2), (1, 0), (1, 0), (1, 0), (1, 0)]
    assert rows(spark.read.parquet(f"{paths[1]}/tracks"), "id") == [("1",)]


def damaged_tracks(write_json, tmp_path, good=2):
    """Good documents of all domains, and two damaged lines among the tracks."""
    for domain in ("albums", "artists", "owners", "playlists"):
        folder = tmp_path / "bronze" / domain / "ingest_date=2024-01-31"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "d.json").write_text('{"id":"1","artists":[{"id":"x"}]}\n')
    folder = tmp_path / "bronze" / "tracks" / "ingest_date=2024-01-31"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f'{{"id":"{i}","album":{{"id":"a"}},"artists":[{{"id":"x"}}]}}' for i in range(good)]
    (folder / "t.json").write_text("\n".join([*lines, '{"id":"cut","album":', '{"id":"3","popularity":"high"}', ""]))
    return str(tmp_path / "bronze")


def test_a_refused_layer_keeps_the_rows_it_had(spark, tmp_path, write_json):
    """Four good rows, then a run over damaged lines; replacing before checking left one of them."""
    source, target = damaged_tracks(write_json, tmp_path), str(tmp_path / "silver")
    replace_date(spark.range(4).selectExpr("cast(id as string) as id"), f"{target}/tracks", "2024-01-31")
    with pytest.raises(layers.LayerFailed, match="tracks: DamagedDocuments: 2 damaged"):
        layers.build_silver(spark, source, target, "2024-01-31")
    assert rows(spark.read.parquet(f"{target}/tracks"), "id") == [(str(i),) for i in range(4)]
    assert not [p for p in (tmp_path / "silver" / "tracks").iterdir() if p.name.startswith("_")]
    layers.build_silver(spark, source, target, "2024-01-31", tolerance=2)
    assert rows(spark.read.parquet(f"{target}/tracks"), "id") == [("0",), ("1",)]


def test_links_count_damage_too(spark, tmp_path, write_json):
    source, target, metrics = damaged_tracks(write_json, tmp_path), str(tmp_path / "links"), str(tmp_path / "metrics")
    overwrite(spark.range(4), f"{target}/track_artists")
    with pytest.raises(layers.LayerFailed, match="track_artists: DamagedDocuments: 2 damaged"):
        layers.build_links(spark, source, target, "2024-01-31", metrics=metrics)
    assert spark.read.parquet(f"{target}/track_artists").count() == 4
    layers.build_links(spark, source, target, "2024-01-31", tolerance=2, metrics=metrics)
    assert rows(spark.read.parquet(f"{target}/track_artists"), "track_id") == [("0",), ("1",)]
    recorded = spark.read.schema(layers.METRICS).parquet(metrics).where("dataset = 'track_artists'")
    assert rows(recorded, "layer", "ingest_date", "rows_in", "rows", "damaged", "columns") == [
        ("links", "2024-01-31", 4, 2, 2, None), ("links", "2024-01-31", 4, 2, 2, 8),
    ]
    assert {r.error is None for r in recorded.collect()} == {True, False}
    assert spark.read.parquet(metrics).count() == 10
