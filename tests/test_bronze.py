import datetime

import pytest
from pyspark.sql import functions as F

from discolake import schemas
from discolake.operators.quality import IncompleteLanding
from discolake.plans import bronze
from discolake.sources.manifests import read_manifest_keys
from discolake.sources.documents import ORD, read_category_map, read_documents, read_domain
from tests.conftest import by_key, rows

RAW_ALBUM = (
    schemas.ALBUM.replace("artists array<struct<id: string>>", "artists array<struct<id: string, uri: string>>")
    + ", available_markets array<string>"
)


def test_prune_albums(frame):
    raw = frame(
        RAW_ALBUM,
        [{"id": "a", "artists": [{"id": "x", "uri": "u"}], "available_markets": ["VN"]}, {"id": "b"}],
    )
    pruned = bronze.prune_albums(raw)
    assert "available_markets" not in pruned.columns
    table = by_key(pruned, "id")
    assert [r.asDict() for r in table["a"].artists] == [{"id": "x"}]
    assert (table["b"].artists, table["b"].copyrights, table["b"].genres) == ([], [], [])
    assert set(pruned.columns) == set(frame(schemas.ALBUM, []).columns)


def test_prune_tracks_and_playlists(frame):
    track = bronze.prune_tracks(frame(schemas.TRACK, [{"id": "t", "album": None, "release_date": "2020"}])).first()
    assert track.album.id is None and track.artists == [] and track.release_date == "2020"
    playlist = bronze.prune_playlists(frame(schemas.PLAYLIST, [{"id": "p", "followers": {"total": 4}}])).first()
    assert playlist.followers.asDict() == {"href": None, "total": 4}
    assert playlist.owner.asDict() == {"display_name": None, "id": None, "type": None}


PLAYLISTS = [
    {"id": "p1", "owner": {"id": "o1", "display_name": "first"}},
    {"id": "p2", "owner": {"id": "", "display_name": "blank"}},
    {"id": "p3", "owner": None},
    {"id": "p4", "owner": {"id": "o2", "display_name": "other"}},
    {"id": "p5", "owner": {"id": "o1", "display_name": "later"}},
    {"id": "p6"},
]


def test_owners_come_first_in_file_order(spark, write_json):
    path = write_json("playlists.json", PLAYLISTS)
    for layout in ("array", "indented"):
        docs = read_documents(spark, path, schemas.PLAYLIST, layout, ordered=True)
        owners = bronze.owners_from_playlists(docs, [ORD])
        assert rows(owners, "id", "display_name") == [("o1", "first"), ("o2", "other")]
        assert owners.columns == ["display_name", "id", "type"]


def test_artists_from_categories(spark, write_json):
    categories = {"Rock": [{"id": "1", "name": "in rock"}, {"id": "2"}], "None": [],
                  "Pop": [{"id": "3"}, {"id": "1", "name": "in pop"}, {"id": None}]}
    path = write_json("categories.json", categories)
    for layout in ("whole", "indented"):
        artists = bronze.artists_from_categories(read_category_map(spark, path, layout))
        assert rows(artists, "id", "name") == [("1", "in rock"), ("2", None), ("3", None)]
        assert artists.columns == ["id", "name", "genres", "followers", "popularity", "type"]


ITEM = (
    "items array<struct<track: struct<id: string, name: string, artists: array<struct<name: string>>,"
    " album: struct<name: string, release_date: string>, duration_ms: bigint, popularity: bigint>>>, total long"
)


def test_normalize_events(frame):
    full = {"id": "1", "name": "n", "artists": [{"name": "A"}, {"name": "B"}],
            "album": {"name": "al", "release_date": "2020"}, "duration_ms": 5, "popularity": 6}
    docs = frame(
        ITEM,
        [
            {"items": [{"track": full}, {"track": None}, None, {"track": {"id": ""}}, {"track": {"name": "x"}}], "total": 5},
            {"items": [{"track": {"id": "2", "artists": []}}], "total": 1},
            {"items": [], "total": 0},
        ],
    )
    stamped = bronze.normalize_events(docs, F.lit("now"))
    table = by_key(stamped, "id")
    assert set(table) == {"1", "2"}
    assert tuple(table["1"]) == ("1", "n", "A", "al", "2020", 5, 6, "now")
    assert table["2"].artist is None
    stamp = bronze.normalize_events(docs).first()["timestamp"]
    assert datetime.datetime.fromisoformat(stamp)


@pytest.fixture
def crawl(tmp_path, write_json):
    """A complete crawl output folder."""
    album = {"id": "a", "name": "A", "artists": [{"id": "x"}], "copyrights": [], "extra": {"kept": [1, {}]}}
    manifest = {"processed_artists": ["x"], "total_albums": 1, "status": "completed"}
    files = {
        "albums.json": [album],
        "albums_processing_metadata.json": manifest,
        "artists.json": [{"id": "x", "name": "X", "followers": {"total": 1}, "genres": []}],
        "owners.json": [{"id": "o"}],
        "playlists.json": [{"id": "p", "owner": {"id": "o"}}],
        "playlists_processing_metadata.json": manifest,
        "tracks.json": [{"id": "t", "album": {"id": "a"}, "artists": [{"id": "x"}], "duration_ms": 1000}],
        "tracks_processing_metadata.json": {"processed_albums": ["a"]},
    }
    for name, value in files.items():
        write_json(f"crawl/{name}", value)
    return tmp_path / "crawl"


def test_landing_is_lossless_and_dated(spark, tmp_path, crawl):
    target = str(tmp_path / "bronze")
    landed = bronze.land(spark, str(crawl), target, "2024-01-31")
    lines = {name: len((crawl / file).read_text().splitlines()) for name, file in bronze.EXPECTED_FILES.items()}
    assert landed == {name: n if name.endswith("_manifest") else 1 for name, n in lines.items()}
    keys = read_manifest_keys(spark, f"{target}/tracks_manifest/ingest_date=2024-01-31", "processed_albums")
    assert rows(keys) == [("a",)]
    text = spark.read.text(f"{target}/albums/ingest_date=2024-01-31").first()["value"]
    assert '"extra": {"kept": [1,{}]}' in text
    docs = read_domain(spark, target, "albums", "2024-01-31", schemas.ALBUM)
    assert rows(docs, "id", "name") == [("a", "A")]


def test_landing_again_replaces_the_date(spark, tmp_path, crawl, write_json):
    target = str(tmp_path / "bronze")
    bronze.land(spark, str(crawl), target, "2024-01-30")
    write_json("crawl/owners.json", [{"id": "o2"}, {"id": "o3"}])
    for _ in range(2):
        assert bronze.land(spark, str(crawl), target, "2024-01-31")["owners"] == 2
    assert rows(read_domain(spark, target, "owners", "2024-01-30", schemas.OWNER), "id") == [("o",)]
    assert rows(read_domain(spark, target, "owners", "2024-01-31", schemas.OWNER), "id") == [("o2",), ("o3",)]


def test_the_gate_stops_landing(spark, tmp_path, crawl, write_json):
    write_json("crawl/owners.json", [])
    (crawl / "tracks.json").unlink()
    with pytest.raises(IncompleteLanding, match=r"owners \(empty\), tracks \(missing\)"):
        bronze.land(spark, str(crawl), str(tmp_path / "bronze"), "2024-01-31")
    assert not (tmp_path / "bronze").exists()


def test_ungated_landing_skips_and_reports(spark, tmp_path, crawl):
    (crawl / "tracks.json").unlink()
    landed = bronze.land(spark, str(crawl), str(tmp_path / "bronze"), "2024-01-31", gated=False)
    assert landed["tracks"] is None and landed["albums"] == 1
    assert not (tmp_path / "bronze" / "tracks").exists()
