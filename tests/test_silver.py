import datetime

import pytest

from discolake import schemas
from discolake.plans import silver
from tests.conftest import by_key, rows

TRACKS = [
    {"id": "t1", "name": "one", "album": {"id": "a1"}, "artists": [{"id": "x"}, {"id": "y"}],
     "disc_number": 1, "track_number": 1, "duration_ms": 90000, "explicit": False,
     "is_local": False, "popularity": 10, "release_date": "2020", "type": "track"},
    {"id": "t2", "album": None, "artists": []},
    {"id": "t3", "album": {"id": None}, "artists": None},
    {"id": "t4", "album": {"id": "a1"}, "artists": [{"id": "x"}, {"id": "x"}, {"id": None}]},
    {"id": None, "album": {"id": "a1"}, "artists": [{"id": "x"}]},
]

ALBUMS = [
    {"id": "a1", "name": "A", "release_date": "2020-05", "artists": [{"id": "x"}, {"id": "007"}],
     "copyrights": [{"text": "p", "type": "P"}], "genres": ["pop", None], "popularity": 3},
    {"id": "a2", "name": "B", "release_date": "N/A", "artists": [{"id": "x"}],
     "copyrights": [{"text": None, "type": "C"}, {"text": "c", "type": "C"}], "genres": []},
    {"id": "a3", "release_date": "2020-01-02", "artists": [], "copyrights": None, "genres": None},
    {"id": None, "release_date": "2020", "artists": [{"id": "x"}]},
]

PLAYLISTS = [
    {"id": "p1", "name": "P", "followers": {"href": None, "total": 5},
     "owner": {"display_name": "D", "id": "o1", "type": "user"}},
    {"id": "p2", "name": None, "followers": None, "owner": None},
    {"id": None, "owner": {"id": "o1"}},
]


def test_tracks(frame):
    table = by_key(silver.tracks(frame(schemas.TRACK, TRACKS)), "id")
    assert table["t1"].asDict() == {
        "id": "t1", "name": "one", "album_id": "a1", "artist_ids": "x,y", "disc_number": 1,
        "track_number": 1, "duration_ms": 90000, "duration_sec": 90.0, "explicit": False,
        "popularity": 10, "release_date": "2020", "is_local": False, "type": "track",
    }
    assert (table["t2"].album_id, table["t2"].artist_ids) == (None, "")
    assert (table["t3"].album_id, table["t3"].artist_ids) == (None, None)
    assert table["t4"].artist_ids == "x,x"
    assert len(table) == 5


def test_tracks_keep_only_present_columns(frame):
    docs = frame(schemas.TRACK, TRACKS).drop("duration_ms", "is_local", "name")
    columns = silver.tracks(docs).columns
    assert columns[:3] == ["id", "album_id", "artist_ids"]
    assert not {"duration_ms", "duration_sec", "is_local", "name"} & set(columns)


def test_tracks_need_album_and_artists(frame):
    with pytest.raises(ValueError, match="artists"):
        silver.tracks(frame(schemas.TRACK, TRACKS).drop("artists"))


def test_albums(frame):
    table = by_key(silver.albums(frame(schemas.ALBUM, ALBUMS)), "album_id")
    assert table["a1"].artist_ids == "x,007"
    assert (table["a1"].genres, table["a2"].genres, table["a3"].genres) == ("pop,None", "", None)
    assert (table["a1"].copyright_text_C, table["a1"].copyright_text_P) == (None, "p")
    assert table["a2"].copyright_text_C is None
    assert table["a2"].release_date == "N/A"
    assert table["a3"].copyright_text_P is None


def test_albums_without_genres_get_a_typed_null(frame):
    table = silver.albums(frame(schemas.ALBUM, ALBUMS).drop("genres"))
    assert table.schema["genres"].dataType.simpleString() == "string"
    assert {r.genres for r in table.collect()} == {None}


def test_artists(frame):
    docs = frame(
        schemas.ARTIST,
        [{"id": "007", "name": "n", "genres": ["a", "b"], "followers": {"total": 9}}, {"id": "8"}],
    )
    table = by_key(silver.artists(docs), "artist_id")
    assert table["007"].asDict() == {
        "artist_id": "007", "name": "n", "genres": "a,b", "followers_total": 9,
        "popularity": None, "type": None,
    }
    assert table["8"].followers_total is None and table["8"].genres is None


def test_owners_and_playlists(frame):
    owners = silver.owners(frame(schemas.OWNER, [{"id": "o", "display_name": "d", "type": "user"}]))
    assert rows(owners) == [("o", "d", "user")] and owners.columns[0] == "owner_id"
    table = by_key(silver.playlists(frame(schemas.PLAYLIST, PLAYLISTS)), "playlist_id")
    assert (table["p1"].owner_id, table["p1"].followers_total) == ("o1", 5)
    assert (table["p2"].owner_id, table["p2"].owner_type, table["p2"].followers_total) == (None,) * 3
    assert len(table) == 3


def test_track_artists_drop_rows_without_a_key(frame):
    links = silver.track_artists(frame(schemas.TRACK, TRACKS))
    assert rows(links, "track_id", "album_id", "artist_id") == [
        ("t1", "a1", "x"), ("t1", "a1", "y"), ("t4", "a1", "x"), ("t4", "a1", "x"),
    ]


def test_album_artists_have_dates(frame):
    links = silver.album_artists(frame(schemas.ALBUM, ALBUMS))
    assert rows(links, "album_id", "artist_id", "release_date") == [
        ("a1", "007", datetime.date(2020, 5, 1)),
        ("a1", "x", datetime.date(2020, 5, 1)),
        ("a2", "x", None),
    ]


def test_typed_entities_drop_null_ids(frame):
    artists = silver.artist_entities(frame(schemas.ARTIST, [{"id": "1", "genres": ["a"]}, {"name": "x"}]))
    assert rows(artists, "artist_id", "genres") == [("1", ["a"])]
    owners = silver.owner_entities(frame(schemas.OWNER, [{"id": "1", "display_name": "d"}, {"id": None}]))
    assert rows(owners) == [("1", "d")]
    playlists = silver.playlist_entities(frame(schemas.PLAYLIST, PLAYLISTS))
    assert rows(playlists, "playlist_id", "followers", "owner_id") == [("p1", 5, "o1"), ("p2", None, None)]
